"""Same records by several natural keys: equal to a union-find over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tabsift.modelling import evaluate as ev
from tabsift.operators import joins, records

KEYS = {"x": ["x"], "y and z": ["y", "z"]}


def union_find(rows, keys):
    """Smallest id and size of every id's component; ``rows`` are dictionaries."""
    over = {r["id"]: r["id"] for r in rows if r["id"] is not None}

    def top(v):
        while over[v] != v:
            v = over[v]
        return v

    for columns in keys.values():
        first = {}
        for r in rows:
            key = tuple(r[c] for c in columns)
            if r["id"] is None or None in key:
                continue
            a, b = top(first.setdefault(key, r["id"])), top(r["id"])
            over[max(a, b)] = min(a, b)
    size = {}
    for v in over:
        size[top(v)] = size.get(top(v), 0) + 1
    return {v: (top(v), size[top(v)]) for v in over}


def agree(spark, rows, schema, ident="id"):
    got = records.same_records(spark.createDataFrame(rows, schema), ident, KEYS).collect()
    assert len(got) == len(rows)
    names = [c.split()[0] for c in schema.split(", ")]
    want = union_find([dict(zip(names, r), id=r[names.index(ident)]) for r in rows], KEYS)
    assert {r[ident]: (r.record_id, r.copies) for r in got if r[ident] is not None} == want
    return got


@pytest.mark.parametrize("name", ["long", "string"])
def test_records_equal_union_find(spark, name):
    """Random keys with missing parts, a third of all rows under one key, ids that are numbers or texts."""
    draw = random.Random(5)
    ids = [i if name == "long" else f"r{i:04d}" for i in range(600)]
    rows = [(v, 0 if draw.random() < 0.3 else draw.choice([None, draw.randrange(1, 900)]), draw.randrange(40), draw.choice([None, *range(30)])) for v in ids]
    agree(spark, rows, f"id {name}, x long, y long, z long")


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A chain of 400 rows, tied by either key in turn, and one record after it."""
    rows = [(i, i // 2, (i + 1) // 2, 0) for i in range(400)] + [(1000, 5000, 5000, 0)]
    written = []
    real = records.staged
    monkeypatch.setattr(records, "staged", lambda df, label: written.append(label) or real(df, label))
    agree(spark, rows, "id long, x long, y long, z long")
    assert written.count("merged") <= 20


def test_cases_that_have_a_defined_answer(spark):
    """Rows without id or with a repeated one, own columns named as the operator's, an empty table, microseconds, minus zero."""
    schema = "b long, x double, y timestamp, z string, a long, k long, to string, row string, id string"
    at = [spark.sql(f"select timestamp'2024-01-01 00:00:00.00000{i}'").first()[0] for i in (1, 2)]
    own = (7, 8, "t", "r", "i")
    rows = [(1, 0.0, at[0], "p", *own), (2, -0.0, at[1], "p", *own), (3, 5.0, at[0], "q", *own), (3, 6.0, None, "q", *own), (4, 6.0, at[1], "s", *own)]
    rows += [(None, 5.0, at[0], "p", *own), (5, 7.0, at[1], "q", *own), (6, 9.0, at[0], "q", *own)]
    df = spark.createDataFrame(rows, schema)
    got = records.same_records(df, "b", KEYS)
    assert got.columns == [*df.columns, "record_id", "copies"]
    assert {(r.b, r.record_id, r.copies) for r in got.collect()} == {(1, 1, 2), (2, 1, 2), (3, 3, 3), (4, 3, 3), (None, None, None), (5, 5, 1), (6, 3, 3)}
    assert records.same_records(df.limit(0), "b", KEYS).collect() == []
    with pytest.raises(ValueError):
        records.same_records(df.withColumn("copies", F.lit(1)), "b", KEYS)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_is_a_join_that_parts_hot_values(spark, how):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else 1 if i % 2 else i % 50) for i in range(500)], "i long, v long")
    side = spark.createDataFrame([(v, f"n{v}") for v in range(0, 40)], "v long, n string")
    want = sorted(map(str, rows.where("v is not null").join(side, "v", how).collect()))
    for shares in (1, 3, 1_000):  # nothing hot, one value hot, all of them
        assert sorted(map(str, joins.lookup(rows, "v", side, how, shares).collect())) == want


def test_planted_copies_explain_bad_errors(spark):
    rows = [(i, i, 100.0 + i % 7, "s") for i in range(60)] + [(100 + i, i, 5000.0, "s") for i in range(4)] + [(200, 900, 7000.0, "s")]
    df = spark.createDataFrame(rows, "id long, owner long, price double, seg string").withColumn("guess", F.lit(100.0))
    odd = ev.residual_causes(df, "price", "guess", "seg", "id", {"owner": ["owner"]})
    assert {(r.id, r.record_id, r.copies) for r in odd.collect()} == {(100, 0, 2), (101, 1, 2), (102, 2, 2), (103, 3, 2), (200, 200, 1)}
    flagged = records.same_records(df, "id", {"owner": ["owner"]})
    table = {r.repeated: (r.rows, r.outliers, r.share) for r in ev.outliers_by_copies(flagged, odd, "id").collect()}
    assert table == {True: (8, 4, 0.5), False: (57, 1, 1 / 57)}
