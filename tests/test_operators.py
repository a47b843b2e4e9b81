"""Operators against hand-made rows, brute force, known figures and their plans."""

import math
import random

import numpy as np
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsift import session
from tabsift.functions import json_fields as J
from tabsift.functions import scalars as S
from tabsift.modelling import evaluate as ev
from tabsift.modelling import series, vectors
from tabsift.operators import aggregates, audit, joins, leakage, profiler, quantiles, rules, sampling, text_features
from tabsift.sources import csv_files, medallion
from tabsift.sources.json_paths import inventory


def brute_quantile(values, p):
    values = sorted(values)
    return values[max(1, math.ceil(p * len(values))) - 1]


# --- quantiles ---------------------------------------------------------------


def test_exact_quantile_after_narrowing(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), round(rng.lognormvariate(0, 4), 3)) for _ in range(20_000)]
    rows += [("hot", 5.0)] * 10_000 + [(None, float(i)) for i in range(501)] + [("a", None)] * 50
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    monkeypatch.setattr(quantiles, "BRACKET_ROWS", 3)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 2_000)
    monkeypatch.setattr(quantiles, "MARGIN", 2 / 2_000)
    probs = {"lo": 0.0, "q1": 0.25, "m": 0.5, "p99": 0.99, "hi": 1.0}
    for r in quantiles.exact(df, "x", probs, by=["g"]).collect():
        own = [x for g, x in rows if g == r["g"] and x is not None]
        assert {k: r[k] for k in probs} == {k: brute_quantile(own, p) for k, p in probs.items()}
    whole = quantiles.exact(df, "x", probs).first()
    assert whole["m"] == brute_quantile([x for _, x in rows if x is not None], 0.5)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.sampled_from([0.1, 0.5, 0.9]))
def test_exact_quantile_equals_sorted(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert quantiles.exact(df, "x", {"q": p}).first()["q"] == brute_quantile(values, p)


def test_quantile_of_nothing(spark):
    assert quantiles.exact(spark.createDataFrame([], "x double"), "x", {"q": 0.5}).count() == 0


# --- scalars -----------------------------------------------------------------


@pytest.mark.parametrize(
    "text, locale, want",
    [
        ("1.234.567,89", "auto", 1234567.89),
        ("1,5", "auto", 1.5),
        ("R$ 12,50", "auto", 12.5),
        ("35 %", "auto", 35.0),
        ("1,234.56", "us", 1234.56),
        ("1.234", "br", 1234.0),
        ("n/a", "auto", None),
        ("-", "auto", None),
        ("", "auto", None),
        ("1d", "auto", None),
        ("1,2,3", "auto", None),
        ("-3e2", "auto", -300.0),
    ],
)
def test_parse_number(spark, text, locale, want):
    assert spark.createDataFrame([(text,)], "t string").select(S.parse_number("t", locale)).first()[0] == want


@pytest.mark.parametrize("text, want", [("12.500.000,00", 12500000.0), ("8200000.00", 8200000.0), (".00", 0.0), ("13", 13.0), ("1.2.3", None)])
def test_parse_amount(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(S.parse_amount("t")).first()[0] == want


def test_capture_is_null_without_match(spark):
    df = spark.createDataFrame([("R$ 12,50 já",), ("nada",), (None,)], "t string")
    assert [r[0] for r in df.select(S.amount_in_text("t")).collect()] == [12.5, None, None]


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-30",), ("31/12/2023",), ("2023/12/31 10:00",), ("ab-cd-efgh",)], "t string")
    assert [str(r[0]) for r in df.select(S.parse_date("t")).collect()] == ["None", "2023-12-31", "2023-12-31", "None"]


def test_nearly_equal_edges(spark):
    rows = [(1.0, 1.0009), (1.0, 1.01), (float("inf"), 1.0), (float("inf"), float("inf")), (float("nan"), float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert [r[0] for r in df.select(S.nearly_equal("a", "b")).collect()] == [True, False, False, False, False, False]


def test_defaults_differ_on_zero_and_blank(spark):
    df = spark.createDataFrame([(None, None), (0, ""), (3, "x")], "n bigint, s string")
    got = df.select(
        J.default_if_missing(F.col("n"), 1), J.default_if_blank(F.col("n"), 1), J.default_if_missing(F.col("s"), "p"), J.default_if_blank(F.col("s"), "p")
    ).collect()
    assert [tuple(r) for r in got] == [(1, 1, "p", "p"), (0, 1, "", "p"), (3, 3, "x", "x")]


def test_word_edges_know_accents(spark):
    df = spark.createDataFrame([("a sala nova",), ("salão",), ("casa",), ("SALA",)], "t string")
    assert [r[0] for r in df.select(S.has_word("t", "sala")).collect()] == [True, False, False, True]


# --- rules and audit ---------------------------------------------------------


def test_rule_report_counts_overlaps_once(spark):
    df = spark.createDataFrame([(1, 1), (99, 1), (1, 99), (99, 99), (None, 1)], "a int, b int")
    checks = [rules.between("a", 0, 10), rules.between("b", 0, 10)]
    report = {r["rule"]: r for r in rules.rule_report(df, checks).collect()}
    assert (report["a_between"]["cut"], report["a_between"]["cut_alone"]) == (3, 2)
    assert (report["b_between"]["cut"], report["b_between"]["cut_alone"]) == (2, 1)
    good, bad = rules.quarantine(df, checks)
    assert good.count() + bad.count() == df.count() and good.count() == report["a_between"]["kept"] == 1


def test_confirm_alarms_on_empty(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    row = rules.confirm(df, df.where("x > 5"), "x").first()
    assert row["is_empty"] and row["rows_before"] == 2 and row["median_before"] == 1.0


def test_gold_filter_reaches_the_scan(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(rules.apply_rules(li, [rules.between("l_extendedprice", 1000, 50000)]).select("l_extendedprice"))
    assert "GreaterThanOrEqual(l_extendedprice" in plan and "ReadSchema: struct<l_extendedprice:double>" in plan


def test_dead_columns_with_hot_value(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") == 7, "B").otherwise("A").alias("near"), F.lit(1).alias("one"), F.col("id").alias("key"), F.lit(None).cast("int").alias("none")
    )
    dead = {r["column"]: r["is_dead"] for r in audit.dead_columns(df).collect()}
    assert dead == {"near": True, "one": True, "key": False, "none": True}


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    plan = plan_of(audit.top_per_group(df, ["g"], [F.desc("id")], 2))
    assert plan.count("WindowGroupLimit") == 2
    assert "WindowGroupLimit" in plan_of(audit.dedup_first(df, ["g"], ["id"]))


def test_fanout_of_a_hot_key(spark):
    left = spark.createDataFrame([(1,)] * 300 + [(2,), (None,)], "k int")
    right = spark.createDataFrame([(1,)] * 4 + [(3,)], "k int")
    r = joins.fanout(left, "k", right, "k").first()
    assert (r["rows_joined"], r["max_right_per_key"], r["left_keys_without_right"], r["right_keys_without_left"]) == (1200, 4, 1, 1)


def test_no_cross_join_or_single_window_in_shares(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for df in (aggregates.class_share(labels, "quality"), sampling.sample_bias(labels, "doc_id", F.col("toxic") == 1, 10)):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Window" not in plan


def test_scale_suspects_report_the_power(spark):
    rows = [("s", float(100 + i)) for i in range(300)] + [("s", 150000.0), ("s", 0.15)]
    found = audit.scale_suspects(spark.createDataFrame(rows, "g string, x double"), "x", "g").collect()
    assert {(r["x"], r["power"]) for r in found} == {(150000.0, 3), (0.15, -3)}


def test_overlap_keeps_null_flags(spark):
    df = spark.createDataFrame([("casa", 1.0), (None, 5.0), (None, 7.0)], "t string, x double")
    got = text_features.overlap(text_features.add_flags(df, "t", {"casa": "casa"}), ["casa"], {"m": "x"}).collect()
    assert {(r["casa"], r["rows"], r["m"]) for r in got} == {(True, 1, 1.0), (None, 2, 5.0)}


# --- sources and profile -----------------------------------------------------


@pytest.mark.parametrize(
    "lines, want",
    [(["a;b;c", '1;"x,y,z";3'], ";"), (["a\tb", "1\t2"], "\t"), (["a|b|c", "1|2|3"], "|"), (["single", "column"], ","), (["a,b", "1,2"], ",")],
)
def test_pick_separator(lines, want):
    assert csv_files.pick_separator(lines) == want


def test_bad_bytes_and_rows_survive(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"a,b\n1,caf\xe9\nx,ok\n3,fine\n")
    rows = csv_files.read_csv(spark, str(tmp_path / "f.csv"), schema="a int, b string", keep_corrupt=True).collect()
    assert len(rows) == 3 and rows[0]["b"] == "caf�" and rows[1]["a"] is None and rows[1][csv_files.CORRUPT] is not None


def test_json_inventory_of_irregular_documents(spark):
    docs = ['{"a":{"b c":[{"d":1},{"d":2}]},"n":null}', '{"a":{"b c":[]},"n":5,"e":{}}', "not json"]
    got = {r["path"]: r for r in inventory(spark.createDataFrame([(d,) for d in docs], "j string"), "j").collect()}
    assert got["a.b c[].d"]["filled"] == 1 and got["n"]["filled"] == 1 and got["n"]["rows"] == 3


def test_profile_types(spark):
    rows = [(str(i), f"R$ {i},50", "2024-01-%02d" % (i % 28 + 1), "x" * 50, "cat%d" % (i % 3), "same") for i in range(200)]
    df = spark.createDataFrame(rows, "id string, money string, day string, note string, kind string, only string")
    got = {r["column"]: (r["type"], r["distinct"], r["is_constant"]) for r in profiler.profile_columns(df).collect()}
    assert got["money"][0] == "number" and got["day"][0] == "date" and got["note"][0] == "text"
    assert got["kind"] == ("category", 3, False) and got["only"] == ("category", 1, True)


def test_cardinality_says_whether_it_is_an_estimate(spark):
    df = spark.range(9000).selectExpr("id", "id % 7 as few")
    rough = {r["column"]: r for r in profiler.profile_columns(df).collect()}
    assert rough["id"]["is_estimate"] and abs(rough["id"]["distinct"] - 9000) < 900
    assert (rough["few"]["distinct"], rough["few"]["is_estimate"]) == (7, False)
    whole = {r["column"]: r for r in profiler.profile_columns(df, exact=True).collect()}
    assert (whole["id"]["distinct"], whole["id"]["is_estimate"]) == (9000, False)


def test_identity_with_a_bad_row_and_ratios_over_zeros(spark):
    df = spark.range(2000).select(
        (F.col("id") % 11).cast("double").alias("b"), (F.col("id") % 13 + 1).cast("double").alias("c"), F.col("id").alias("i")
    )
    df = df.withColumn("a", F.when(F.col("i") == 900, -5.0).otherwise(F.col("b") * F.col("c"))).drop("i")
    found = {r["formula"]: r for r in profiler.identity_hunt(df, ["a", "b", "c"], ratio=True).collect()}
    assert {"b * c", "a / b", "a / c"} <= set(found)
    assert found["b * c"]["pct"] == 99.95 and found["a / b"]["rows"] == 2000 - df.where("b = 0").count()


@pytest.mark.parametrize("kind, values", [("bigint", [2**60 + i * 3 for i in range(9)]), ("bigint", [2**63 - 1 - i for i in range(9)]), ("decimal(38,4)", [f"{10**30 + i}.0001" for i in range(9)]), ("date", [f"2024-01-{i + 1:02d}" for i in range(9)]), ("timestamp", [f"2024-01-01 00:00:{i:02d}.000001" for i in range(9)])])
def test_quantiles_keep_the_type_of_the_column(spark, kind, values):
    df = spark.createDataFrame([(str(v),) for v in values], "s string").select(F.col("s").cast(kind).alias("x"))
    want = sorted(r.x for r in df.collect())[4]
    found = quantiles.exact(df, "x", {"m": 0.5})
    assert found.first()["m"] == want and found.schema["m"].dataType == df.schema["x"].dataType
    with pytest.raises(TypeError, match="string"):
        quantiles.exact(df.select(F.lit("a").alias("x")), "x", {"m": 0.5})


def test_medians_of_several_columns_and_of_the_null_group(spark):
    df = spark.createDataFrame([(None, 1.0, 10), (None, 3.0, 30), ("a", 5.0, 50)], "g string, x double, y bigint")
    got = {r["g"]: (r["mx"], r["my"]) for r in aggregates.profile_groups(df, "g", {"mx": "x", "my": "y"}, {}, {}).collect()}
    assert got == {None: (1.0, 10.0), "a": (5.0, 50.0)}


def test_null_segments_and_null_texts(spark):
    rows = [(None, float(100 + i % 5)) for i in range(200)] + [(None, 100_000.0)] + [("a", float(i % 3 + 5)) for i in range(50)]
    odd = audit.scale_suspects(spark.createDataFrame(rows, "s string, x double"), "x", "s").collect()
    assert [(r["s"], r["x"], r["power"]) for r in odd] == [(None, 100_000.0, 3)]
    texts = spark.createDataFrame([(1, None), (2, None), (3, "t"), (4, "t")], "i int, t string")
    assert [r["copies"] for r in audit.duplicate_texts(texts, "t", "i").collect()] == [2]


def test_lags_follow_the_calendar(spark):
    df = spark.createDataFrame([("g", "2024-01-01", 1.0), ("g", "2024-02-01", 2.0), ("g", "2024-05-01", 5.0), (None, "2024-06-01", 6.0)], "k string, m string, value double")
    got = series.with_lags(df.select("k", F.col("m").cast("date").alias("month"), "value"), ["k"], [1, 3]).collect()
    assert {(r["k"], r["month"].month): (r["lag_1"], r["lag_3"]) for r in got} == {("g", 1): (None, None), ("g", 2): (1.0, None), ("g", 5): (None, 2.0), (None, 6): (None, None)}


def test_json_arrays_count_all_elements(spark):
    docs = ['{"a":[{"x":1},{"y":2}],"q\'s":1}', '{"a":[{"x":1},{"x":3}],"b":[[1],[2,2]]}']
    got = {r["path"]: r for r in inventory(spark.createDataFrame([(d,) for d in docs], "j string"), "j").collect()}
    assert got["a[].y"]["filled"] == 1 and got["a[].x"]["filled"] == 2 and not got["a[].x"]["is_constant"]
    assert got["b[][]"]["filled"] == 1 and got["b[][]"]["distinct_approx"] == 2 and got["q's"]["filled"] == 1


def test_neighbours_of_a_query_without_a_vector(spark):
    rows = [(1, None), (2, [1.0, 0.0]), (3, [0.9, 0.1]), (4, [0.0, 1.0])]
    e = spark.createDataFrame(rows, "i int, v array<double>")
    got = vectors.vector_search(e, e, 1, "i", "v", "i", "v", skip_self=True).collect()
    assert {(r["query"], r["neighbour"]) for r in got} == {(2, 3), (3, 2), (4, 3)}


def test_shared_folder_is_never_invented_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_correlation_across_a_join_survives_large_values(spark):
    facts = spark.range(1000).select((F.col("id") % 10).alias("k"), (1e9 + F.col("id") % 10 + (F.col("id") * 7919 % 100) * 1e-4).alias("x"))
    dims = spark.range(10).select(F.col("id").alias("k"), (1e9 + F.col("id")).alias("y"))
    assert aggregates.joined_correlation(facts, "x", "k", dims, "y", "k", 3).first()["corr"] == 1.0


def test_identity_hunt_is_row_aligned_and_can_be_partial(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 7 != 0, F.col("id").cast("double")).alias("a"),
        (F.col("id") * 3 + 11).cast("double").alias("b"),
        (F.col("id") * (F.col("id") * 3 + 11)).cast("double").alias("ab"),
    )
    assert [(r["target"], r["formula"], r["pct"]) for r in profiler.identity_hunt(df, ["a", "b", "ab"]).collect()] == [("ab", "a * b", 100.0)]
    dirty = df.withColumn("ab", F.when(F.col("a") % 10 == 3, -1.0).otherwise(F.col("ab")))
    assert profiler.identity_hunt(dirty, ["a", "b", "ab"], min_share=1.0).count() == 0
    part = {(r["target"], r["formula"]) for r in profiler.identity_hunt(dirty, ["a", "b", "ab"], min_share=0.8).collect()}
    assert part == {("ab", "a * b")}


# --- metrics -----------------------------------------------------------------


def test_known_confusion_figures(spark):
    """146 / 5 / 3 / 16 of 170 give accuracy .953, precision .762, recall .842, F1 .800."""
    cells = [(False, False, 146), (False, True, 5), (True, False, 3), (True, True, 16)]
    rows = [(t, p, 0.9 if p else 0.1) for t, p, n in cells for _ in range(n)]
    df = spark.createDataFrame(rows, "t boolean, p boolean, s double")
    m = ev.classification_metrics(df, F.col("t"), F.col("p"), F.col("s")).first()
    assert [round(m[k], 3) for k in ("accuracy", "precision", "recall", "f1_score")] == [0.953, 0.762, 0.842, 0.8]
    table = {r["expected_label"]: (r["predicted_false"], r["predicted_true"]) for r in ev.confusion_matrix(df, "t", "p", [False, True]).collect()}
    assert table == {"false": (146, 5), "true": (3, 16)}
    majority = spark.createDataFrame([(False,)] * 741 + [(True,)] * 146, "y boolean")
    assert ev.majority_baseline(majority, "y").first()["accuracy_pct"] == 83.5


def test_auc_by_bins_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ev, "BIN_ROWS", 100)
    rng = random.Random(3)
    rows = [(rng.random() < 0.3, round(rng.random() ** 2, 2)) for _ in range(600)] + [(True, 0.5)] * 200 + [(False, 0.5)] * 100
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    got = ev.roc_auc(spark.createDataFrame(rows, "y boolean, s double"), "y", "s").first()[0]
    assert got == pytest.approx(want, abs=1e-12)


def test_mean_baseline_has_no_skill(spark):
    m = ev.mean_baseline(spark.range(100).select(F.col("id").cast("double").alias("y")), "y").first()
    assert m["r2_score"] == pytest.approx(0, abs=1e-12)


def test_lineage_is_transitive():
    catalog = {f.name: f for f in (leakage.Feature("label", ("title",)), leakage.Feature("a", ("b",)), leakage.Feature("b", ("title",)))}
    assert [f for f, _ in leakage.lineage_verdicts(["a", "b", "title", "size"], "label", catalog)] == ["a", "b", "title"]
    with pytest.raises(leakage.LeakageError):
        leakage.refuse_leaks(["a"], "label", catalog)


def test_dropped_columns_keep_their_reasons(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id int, status string, price double")
    kept, report = rules.drop_columns(df, {"id": "identifier", "status": "constant"})
    assert kept.columns == ["price"] and dict(report.collect()) == {"id": "identifier", "status": "constant"}
    with pytest.raises(ValueError):
        rules.drop_columns(df, {"nope": "typo"})


def test_sql_bindings_and_statements(spark):
    df = spark.range(10)
    assert medallion.query(spark, "select count(*) as n from {t} where id >= :low", t=df, low=4).first()["n"] == 6
    medallion.statement(spark, "create or replace temporary view seven as select 7 as n")
    assert spark.table("seven").first()["n"] == 7


def test_shared_dir_without_setting(spark, monkeypatch, tmp_path):
    from tabsift import session

    class Context:
        master = "local[2]"
        made = None

        def getCheckpointDir(self):
            return self.made

        def setCheckpointDir(self, path):
            self.made = path

    class Bare:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    first = session.shared_dir(Bare)
    assert first and session.shared_dir(Bare) == first


def test_large_side_is_not_broadcast(spark):
    from tabsift.session import broadcast_if_small

    df = spark.range(50)
    assert broadcast_if_small(df, 10) is df
    assert broadcast_if_small(df, 50) is not df


def test_wide_groups_join_brackets_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", 5)
    df = spark.range(400).select((F.col("id") % 20).alias("g"), F.col("id").cast("double").alias("x"))
    got = {r["g"]: r["m"] for r in quantiles.exact(df, "x", {"m": 0.5}, by=["g"]).collect()}
    assert got == {g: brute_quantile([float(i) for i in range(400) if i % 20 == g], 0.5) for g in range(20)}


def test_tokens_of_whole_text(spark):
    text = " ".join(f"w{i}" for i in range(30_000)) + " fim"
    df = spark.createDataFrame([(text, False), ("fim w1", True)], "t string, c boolean")
    got = {r["token"]: (r["uncovered_rows"], r["covered_rows"], r["lift"]) for r in text_features.uncovered_tokens(df, "t", F.col("c")).collect()}
    assert len(got) == 30_001 and got["fim"] == (1, 1, 1.0) and got["w29999"] == (1, 0, None)


@pytest.mark.parametrize("ratio", [False, True])
def test_identity_search_finds_what_the_full_hunt_finds(spark, ratio):
    """Small whole numbers that often agree by chance, gaps, zeros, not-a-number, infinities, a nearly empty column."""
    rng, n = np.random.default_rng(3), 3000
    cols = {f"c{i}": rng.integers(0, 4 + 40 * i, n).astype(float) for i in range(8)}
    cols |= {"sum": cols["c3"] + cols["c5"], "dup": cols["c6"].copy(), "part": cols["c4"] * cols["c7"], "rate": cols["c6"] / np.maximum(cols["c2"], 1)}
    cols["part"][: n // 200] += 5
    cols["dup"][rng.random(n) < 0.4] = None
    cols["rare"] = np.where(np.arange(n) < 60, cols["c1"] - cols["c6"], np.nan)
    cols["odd"] = np.where(rng.random(n) < 0.01, np.inf, cols["c5"])
    rows = [tuple(None if k in ("dup", "rare") and np.isnan(v[i]) else float(v[i]) for k, v in cols.items()) for i in range(n)]
    rows[5] = (float("nan"), *rows[5][1:])
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    for share, probe in ((0.99, 0.2), (0.99, 0.0), (0.8, 1.0), (1.0, 0.05)):
        full = profiler.identity_hunt(df, list(cols), min_share=share, ratio=ratio).collect()
        assert profiler.identity_search(df, list(cols), min_share=share, ratio=ratio, probe_share=probe).collect() == full
    assert {("sum", "c3 + c5"), ("dup", "c6"), ("rare", "c1 - c6")} <= {(r.target, r.formula) for r in profiler.identity_hunt(df, list(cols)).collect()}


def test_identity_search_over_nothing(spark):
    empty = spark.createDataFrame([], "a double, b int")
    assert profiler.identity_search(empty, ["a", "b"]).collect() == []
    assert profiler.identity_search(spark.createDataFrame([(1.0, 2)], "a double, b int"), ["a", "b"]).collect() == []


def test_identity_search_counts_on_the_columns_left_only(spark, monkeypatch):
    rng = np.random.default_rng(6)
    cols = {f"c{i}": rng.random(2000) * 1000 for i in range(8)}
    cols["sum"] = cols["c2"] + cols["c5"]
    df = spark.createDataFrame([tuple(map(float, r)) for r in np.column_stack(list(cols.values()))], ", ".join(f"{c} double" for c in cols))
    whole = profiler._counter

    def counter(left, tolerance):
        run = whole(left, tolerance)

        def checked(batches):
            for batch in batches:
                assert batch.schema.names == ["c2", "c5", "sum"]
                yield from run([batch])

        return checked

    monkeypatch.setattr(profiler, "_counter", counter)
    found = profiler.identity_search(df, list(cols), probe_share=1.0).collect()
    assert {(r.target, r.formula) for r in found} == {("sum", "c2 + c5"), ("c2", "sum - c5"), ("c5", "sum - c2")}
    assert {r.rows for r in found} == {2000}


def test_identity_probe_rules_out_all_but_few(spark):
    """Sixty columns: of 410,640 formulas only a few are left to count."""
    n, rng = 2000, np.random.default_rng(5)
    values = rng.random((n, 60)) * 1000
    values[:, 59] = values[:, 3] * values[:, 7]
    names = [f"c{i}" for i in range(60)]
    formulas = profiler._formulas(60, False)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(values[:200, i]) for i in range(60)], names)
    (out,) = profiler._prober(formulas, 1e-3)([batch])
    misses = np.zeros(len(formulas) * 60, np.int64)
    misses[out["place"].to_numpy()] = out["misses"].to_numpy()
    left = profiler._survivors(names, np.full(60, n), formulas, misses.reshape(-1, 60), 0.99)
    assert [(i.target, i.formula) for i in left] == [("c59", "c3 * c7")]


@pytest.mark.parametrize("bin_rows", [50, 100_000])
def test_area_under_the_curve_equals_all_pairs(spark, bin_rows, monkeypatch):
    """Scores a rounding step apart, one score that a third of the rows share, zeros of both signs, infinities, gaps."""
    monkeypatch.setattr(ev, "BIN_ROWS", bin_rows)
    rng = np.random.default_rng(7)
    s = np.concatenate([1 + rng.integers(0, 900, 900) * 2.0**-52, np.full(700, 0.5), rng.normal(size=500), [0.0, -0.0, np.inf, -np.inf] * 5])
    y = rng.random(len(s)) < 0.3 + 0.2 * (s > 1 + 400 * 2.0**-52)
    rows = [(float(a), bool(b)) for a, b in zip(s, y, strict=True)] + [(None, True), (0.1, None), (float("nan"), True)]
    got = ev.roc_auc(spark.createDataFrame(rows, "s double, y boolean"), "y", "s").first().roc_auc
    above, below = s[y][:, None], s[~y][None, :]
    assert got == pytest.approx(((above > below) + 0.5 * (above == below)).mean(), abs=1e-12)
    assert ev.roc_auc(spark.createDataFrame(rows[-3:], "s double, y boolean"), "y", "s").first().roc_auc is None
