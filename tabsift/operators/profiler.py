"""Profile any table: types by content, dead columns, arithmetic identities, targets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..session import small_methods
from . import aggregates

# Fixed values of the profile.
MAX_CATEGORIES = 60
MIN_TEXT_CHARS = 40
MIN_MONTHS = 24
MIN_IDENTITY_VALUES = 50
IDENTITY_SHARE = 0.99
HIGH_SHARE = 0.9
PREVIEW_ROWS, PREVIEW_CHARS = 3, 70


def _parts(df: DataFrame, c: str) -> dict[str, Column]:
    """Emptiness, number, date and text of a cell, from its type or from its content."""
    dtype, x = df.schema[c].dataType, F.col(f"`{c}`")
    none_d, none_t = F.lit(None).cast("double"), F.lit(None).cast("date")
    if isinstance(dtype, T.NumericType):
        return {"empty": x.isNull(), "number": x.cast("double"), "date": none_t, "text": F.lit(None).cast("string")}
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return {"empty": x.isNull(), "number": none_d, "date": x.cast("date"), "text": x.cast("string")}
    s = x.cast("string")
    empty = s.isNull() | (F.trim(s) == "")
    number = F.when(~empty, S.parse_number(s))
    other = ~empty & number.isNull()
    return {"empty": empty, "number": number, "date": F.when(other, S.parse_date(s)), "text": F.when(other, s)}


# Columns whose estimate is at most this are counted exactly; the rest only on request.
EXACT_DISTINCT = 5_000


def _facts(df: DataFrame, exact: bool = False) -> list[dict]:
    """Everything the profile needs about every column: one wide aggregate, one row.

    Distinct values are counted in a second pass, of all columns with ``exact``
    and else of those with few; the others keep their estimate, and say so.
    """
    cells, aggs = [], [F.count("*").alias("n")]
    for i, c in enumerate(df.columns):
        p = _parts(df, c)
        cells += [
            p["empty"].alias(f"e{i}"),
            p["number"].alias(f"x{i}"),
            p["date"].alias(f"d{i}"),
            F.length(p["text"]).alias(f"t{i}"),
            F.xxhash64(F.when(~p["empty"], F.col(f"`{c}`"))).alias(f"h{i}"),
        ]
        finite = F.when(S.finite(F.col(f"x{i}")), F.col(f"x{i}"))
        aggs += [
            F.count_if(f"e{i}").alias(f"empty{i}"),
            F.count(f"x{i}").alias(f"numbers{i}"),
            F.count(f"d{i}").alias(f"dates{i}"),
            F.min(f"d{i}").alias(f"first{i}"),
            F.max(f"d{i}").alias(f"last{i}"),
            F.percentile_approx(finite, HIGH_SHARE, 10_000).alias(f"high{i}"),
            F.avg(f"t{i}").alias(f"chars{i}"),
            F.avg(finite).alias(f"mean{i}"),
            F.stddev_pop(finite).alias(f"sd{i}"),
            F.approx_count_distinct(F.when(~F.col(f"e{i}"), F.col(f"h{i}")), 0.02).alias(f"about{i}"),
        ]
    wide = df.select(*cells).agg(*aggs).first().asDict()
    names = ("empty", "numbers", "dates", "chars", "about", "mean", "sd", "first", "last", "high")
    facts = [{"column": c, "n": wide["n"], **{k: wide[f"{k}{i}"] for k in names}} for i, c in enumerate(df.columns)]
    cell = lambda c: F.when(~_parts(df, c)["empty"], F.col(f"`{c}`").cast("string"))
    counted = [f["column"] for f in facts if exact or f["about"] <= EXACT_DISTINCT]
    dated = [f["column"] for f in facts if f["dates"] > 0.5 * f["n"]]
    month = lambda c: F.date_format(_parts(df, c)["date"], "yyyy-MM")
    second = [cell(c).alias(f"d:{c}") for c in counted] + [month(c).alias(f"m:{c}") for c in dated]
    seen = aggregates.distinct_counts(df.select(*second), [f"d:{c}" for c in counted] + [f"m:{c}" for c in dated]).first().asDict() if second else {}
    for f in facts:
        f["distinct"] = seen.get(f"d:{f['column']}", f["about"])
        f["is_estimate"] = f["column"] not in counted
        f["months"] = seen.get(f"m:{f['column']}", 0)
        f["type"] = _type(f)
    constant = [f["column"] for f in facts if f["distinct"] <= 1]
    values = df.agg(*[F.max(cell(c)).alias(c) for c in constant]).first().asDict() if constant else {}
    for f in facts:
        f["value"] = values.get(f["column"])
    return facts


def _type(f: dict) -> str:
    filled = f["n"] - f["empty"]
    if f["dates"] > 0.5 * f["n"]:
        return "date"
    if f["numbers"] and f["numbers"] == filled:
        return "number"
    return "text" if (f["chars"] or 0) >= MIN_TEXT_CHARS else "category"


def profile_columns(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: type by content, distinct values, empty cells, constants.

    ``exact`` counts the distinct values of all columns, not only of those with few.
    """
    rows = [
        (f["column"], f["type"], f["distinct"], f["is_estimate"], f["empty"], f["distinct"] <= 1, f["value"]) for f in _facts(df, exact)
    ]
    schema = "column string, type string, distinct bigint, is_estimate boolean, empty bigint, is_constant boolean, constant_value string"
    return df.sparkSession.createDataFrame(rows, schema)


def target_candidates(df: DataFrame) -> DataFrame:
    """Columns worth predicting or mining, by kind of task, with the figure that decides.

    A regression target comes with its mean and deviation, the error of always
    guessing the mean; a time series with its first and last day. Where no
    category fits, each numeric column offers a binary target, whether it lies
    above its 90th percentile.
    """
    facts, rows = _facts(df), []
    numeric = [f for f in facts if f["type"] == "number" and f["numbers"] >= 10]
    for f in sorted(numeric, key=lambda f: -f["numbers"]):
        cv = f["sd"] / f["mean"] if f["mean"] else 0.0
        good = 0.3 < cv < 5 and f["distinct"] > 100
        rows.append(("regression", f["column"], "cv", round(cv, 4), good, None, None))
        rows.append(("regression", f["column"], "mean", round(f["mean"] or 0.0, 2), good, None, None))
        rows.append(("regression", f["column"], "stddev", round(f["sd"] or 0.0, 2), good, None, None))
    classes = [f for f in facts if f["type"] == "category" and 2 <= f["distinct"] <= MAX_CATEGORIES]
    rows += [("classification", f["column"], "categories", float(f["distinct"]), True, None, None) for f in classes]
    if not classes:
        rows += [("classification", f["column"], "above_p90", f["high"], True, None, None) for f in numeric]
    for f in facts:
        if f["type"] == "date":
            rows.append(("time_series", f["column"], "months", float(f["months"]), f["months"] >= MIN_MONTHS, f["first"], f["last"]))
        if f["type"] == "text":
            rows.append(("free_text", f["column"], "mean_chars", round(f["chars"], 2), True, None, None))
    schema = "task string, column string, measure string, value double, good boolean, first_day date, last_day date"
    return df.sparkSession.createDataFrame(rows, schema)


def preview(df: DataFrame, order: Sequence[str], rows: int = PREVIEW_ROWS, chars: int = PREVIEW_CHARS) -> DataFrame:
    """The first rows in a stated order, each value cut to a readable length."""
    return df.orderBy(*order).limit(rows).select(*[F.substring(F.col(c).cast("string"), 1, chars).alias(c) for c in df.columns])


# The arithmetic tried, on arrays of numbers.
OPERATIONS = {
    "{a}": lambda a, b: a,
    "{a} * {b}": lambda a, b: a * b,
    "{a} + {b}": lambda a, b: a + b,
    "{a} - {b}": lambda a, b: a - b,
    "{b} - {a}": lambda a, b: b - a,
}
RATIOS = {"{a} / {b}": lambda a, b: a / b, "{b} / {a}": lambda a, b: b / a}


@dataclass(frozen=True)
class Identity:
    """A candidate ``target = formula`` over one or two other columns."""

    target: str
    shape: str
    a: str
    b: str | None = None

    @property
    def formula(self) -> str:
        return self.shape.format(a=self.a, b=self.b)


def identity_candidates(columns: Sequence[str], ratio: bool = False) -> list[Identity]:
    """Every copy, product, sum and difference (and quotient) that could make a column."""
    pairwise = [s for s in {**OPERATIONS, **(RATIOS if ratio else {})} if "{b}" in s]
    out = []
    for y in columns:
        rest = [c for c in columns if c != y]
        out += [Identity(y, "{a}", a) for a in rest]
        out += [Identity(y, shape, a, b) for a, b in combinations(rest, 2) for shape in pairwise]
    return out


def identity_hunt(
    df: DataFrame, columns: Sequence[str], tolerance: float = S.RELATIVE_TOLERANCE, min_share: float = IDENTITY_SHARE, ratio: bool = False
) -> DataFrame:
    """Columns that are a copy or arithmetic result of others on nearly all rows, with the share that is.

    One scan counts every formula over all rows: tasks add up hits per formula
    batch by batch, and only those sums are shuffled. Rows with a missing side,
    a division by zero among them, say nothing either way.
    """
    enough = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    live = identity_candidates([c for c in columns if enough[c] >= MIN_IDENTITY_VALUES], ratio)
    numbers = df.select(*[F.col(c).cast("double") for c in columns])
    counted = numbers.mapInArrow(_counter(live, tolerance), "formula int, hits bigint, seen bigint")
    sums = counted.groupBy("formula").agg(F.sum("hits").alias("hits"), F.sum("seen").alias("seen")).collect()
    rows = [
        (live[r.formula].target, live[r.formula].formula, r.seen, round(100.0 * r.hits / r.seen, 2))
        for r in sorted(sums, key=lambda r: r.formula)
        if r.seen and r.hits / r.seen >= min_share
    ]
    return df.sparkSession.createDataFrame(rows, "target string, formula string, rows bigint, pct double")


def _counter(candidates: Sequence[Identity], tolerance: float):
    """A task's hits and rows per formula."""
    shapes = {**OPERATIONS, **RATIOS}
    plan = [(c.target, shapes[c.shape], c.a, c.b, c.shape) for c in candidates]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hits, seen = np.zeros(len(plan), np.int64), np.zeros(len(plan), np.int64)
        for batch in batches:
            values = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
            known = {n: batch.column(n).is_valid().to_numpy(zero_copy_only=False) for n in batch.schema.names}
            with np.errstate(all="ignore"):
                for i, (target, fn, a, b, shape) in enumerate(plan):
                    y, v = values[target], fn(values[a], values[b] if b else None)
                    there = known[target] & known[a] & (known[b] if b else True)
                    if "/" in shape:
                        there = there & (values[b if shape.startswith("{a}") else a] != 0)
                    apart = np.abs(v - y)
                    close = apart <= tolerance * np.maximum(np.maximum(np.abs(v), np.abs(y)), 1.0)
                    seen[i] += np.count_nonzero(there)
                    hits[i] += np.count_nonzero(there & np.isfinite(apart) & close)
        if len(plan):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(plan), dtype=np.int32)), pa.array(hits), pa.array(seen)], ["formula", "hits", "seen"]
            )

    return run


# The share of rows on which every formula is tried before the rest are counted on all rows. A formula that is wrong on
# most rows is ruled out if this is well above the share of rows that may break an identity.
PROBE_SHARE = 0.03
# Rows of the probe that one task takes, and formula values that it holds at a time.
PROBE_ROWS = 50_000
PROBE_VALUES = 2_000_000


def identity_search(
    df: DataFrame,
    columns: Sequence[str],
    tolerance: float = S.RELATIVE_TOLERANCE,
    min_share: float = IDENTITY_SHARE,
    ratio: bool = False,
    probe_share: float = PROBE_SHARE,
) -> DataFrame:
    """What ``identity_hunt`` finds, without trying every formula on every row: for tables of many columns.

    On a probe of the rows, drawn at random, the value of each ``a ∘ b`` is looked up among the row's sorted
    values, which takes the square of the columns and not the cube, and gives every formula's misses there. A formula
    may miss on ``1 - min_share`` of the rows that have all its columns, so one that missed more often in the probe
    alone is ruled out for certain; all others are counted on all rows. The probe decides the cost, never the answer.
    The driver holds one number per formula, the cube of the columns.
    """
    import numpy as np

    with small_methods(df.sparkSession):
        known = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    used = [(c, known[f"k{i}"]) for i, c in enumerate(columns) if known[f"k{i}"] >= MIN_IDENTITY_VALUES]
    names, filled = [c for c, _ in used], np.array([k for _, k in used], np.int64)
    numbers = df.select(*[F.col(c).cast("double") for c in names])
    formulas = _formulas(len(names), ratio)
    left: list[Identity] = []
    if names:
        # No column is worked out for the rows that are not drawn.
        probe = df.where(F.rand(42) < probe_share).select(*[F.col(c).cast("double") for c in names]).repartition(1 + int(known["_rows"] * probe_share) // PROBE_ROWS)
        sums = probe.mapInArrow(_prober(formulas, tolerance), "place bigint, misses bigint").groupBy("place").agg(F.sum("misses").alias("misses"))
        found = sums.toArrow()
        misses = np.zeros(len(formulas) * len(names), np.int64)
        misses[found["place"].to_numpy()] = found["misses"].to_numpy()
        left = _survivors(names, filled, formulas, misses.reshape(len(formulas), len(names)), min_share)
    asked = [c for c in names if any(c in (i.target, i.a, i.b) for i in left)]  # no other column leaves the JVM
    counted = numbers.select(*asked).mapInArrow(_counter(left, tolerance), "formula int, hits bigint, seen bigint") if left else None
    totals = counted.groupBy("formula").agg(F.sum("hits").alias("hits"), F.sum("seen").alias("seen")).collect() if left else []
    rows = [
        (left[r.formula].target, left[r.formula].formula, r.seen, round(100.0 * r.hits / r.seen, 2))
        for r in sorted(totals, key=lambda r: r.formula)
        if r.seen and r.hits / r.seen >= min_share
    ]
    return df.sparkSession.createDataFrame(rows, "target string, formula string, rows bigint, pct double")


def _formulas(n: int, ratio: bool) -> list[tuple[str, int, int]]:
    """Every formula over columns numbered from 0, shape by shape; copies have no second column (-1)."""
    shapes = {**OPERATIONS, **(RATIOS if ratio else {})}
    pairs = list(combinations(range(n), 2))
    return [(s, a, b) for s in shapes for a, b in (pairs if "{b}" in s else [(i, -1) for i in range(n)])]


def _survivors(names, filled, formulas, misses, min_share) -> list[Identity]:
    """The formulas whose misses leave room for an identity; no more rows have all columns than have the rarest one."""
    import numpy as np

    a = np.array([f[1] for f in formulas])
    b = np.array([f[2] if f[2] >= 0 else f[1] for f in formulas])
    most = np.minimum(np.minimum(filled[a], filled[b])[:, None], filled[None, :])
    open_ = misses <= (1 - min_share) * most + 1e-6
    open_[np.arange(len(formulas)), a] = False
    open_[np.arange(len(formulas)), b] = False
    found = [(y, formulas[f], f) for f, y in zip(*(x.tolist() for x in np.nonzero(open_)), strict=True)]
    found.sort(key=lambda c: (c[0], c[1][2] >= 0, c[1][1:], c[2]))  # per target copies first, as the full hunt lists them
    return [Identity(names[y], shape, names[a], names[b] if b >= 0 else None) for y, (shape, a, b), _ in found]


def _prober(formulas: Sequence[tuple[str, int, int]], tolerance: float):
    """A task's misses of every formula as each column, with places ``formula * columns + column``."""
    shapes = {**OPERATIONS, **RATIOS}

    def run(batches):
        import numpy as np
        import pyarrow as pa

        groups = [(s, np.array([f[1:] for f in formulas if f[0] == s])) for s in shapes if any(f[0] == s for f in formulas)]
        misses, width = None, 0
        for batch in batches:
            table = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64)
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            width = table.shape[1]
            misses = np.zeros((len(formulas), width), np.int64) if misses is None else misses
            step = max(1, PROBE_VALUES // len(formulas))
            for at in range(0, len(table), step):
                misses += _misses(table[at : at + step], there[at : at + step], groups, shapes, tolerance, np)
        if misses is not None:
            flat = misses.ravel()
            places = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(flat[places])], ["place", "misses"])

    return run


def _misses(table, there, groups, shapes, tolerance, np):
    """Misses of every formula as each column on these rows, CACHED_ROWS at a time."""
    width, count = table.shape[1], sum(len(pairs) for _, pairs in groups)
    hits, seen = np.zeros(count * width, np.int64), np.zeros((count, width), np.int64)
    with np.errstate(all="ignore"):
        for at in range(0, len(table), CACHED_ROWS):
            t, known = np.ascontiguousarray(table[at : at + CACHED_ROWS].T), np.ascontiguousarray(there[at : at + CACHED_ROWS].T)
            values, usable = [], []
            for shape, pairs in groups:
                a, b = pairs[:, 0], pairs[:, 1]
                ok = known[a] & known[b] if "{b}" in shape else known[a]
                if "/" in shape:
                    ok = ok & (t[b if shape.startswith("{a}") else a] != 0)
                values.append(shapes[shape](t[a], t[b]))
                usable.append(ok)
            values, usable = np.concatenate(values), np.concatenate(usable)
            full = known.all() and usable.all()
            seen += t.shape[1] if full else (usable.astype(np.float32) @ known.T.astype(np.float32)).astype(np.int64)  # whole numbers below 2^24
            _add_hits(hits, t, known & np.isfinite(t), values, usable & np.isfinite(values), tolerance, np)
    return seen - hits.reshape(seen.shape)


# Rows whose values are looked up together, so that they stay in the processor's cache, and pairs compared at a time.
CACHED_ROWS = 32
COMPARED = 1_000_000


def _add_hits(hits, t, live, values, usable, tolerance, np):
    """Count every value that is close to a column of its row: ``t`` is columns x rows, ``values`` formulas x rows.

    A number's bucket is its place on a scale that is linear near zero and goes with the exponent beyond. Buckets are as wide as
    numbers can be apart that are close, so those of a row lie in one bucket or in two side by side.
    """
    width, rows = t.shape
    apart = (1 << 24) * tolerance / max(1e-9, 1 - tolerance) + 4
    shift = min(31, max(14, int(np.ceil(np.log2(apart)))))  # wide enough for a list of all buckets
    one = int(np.float32(1).view(np.int32))

    def bucket(x):
        scale = (np.abs(x) + 1).astype(np.float32).view(np.int32) - np.int32(one)
        return np.where(x < 0, -scale, scale) >> np.int32(shift)

    column, row = np.nonzero(live)
    if not len(column):
        return
    own = bucket(t)[column, row].astype(np.int64)
    around = np.concatenate([own - 1, own, own + 1])
    low, span = around.min(), int(around.max() - around.min()) + 1
    code = np.tile(row, 3) * span + (around - low)
    order = np.argsort(code, kind="stable")
    code, column = code[order], np.tile(column, 3)[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    several = np.diff(np.append(first, len(code)))
    begins = np.full(rows * span, -1, np.int32)
    begins[code[first]] = np.arange(len(first), dtype=np.int32)
    asked = bucket(values) - np.int32(low)
    inside = usable & (asked >= 0) & (asked < span)
    run = begins.take(asked + np.arange(rows, dtype=np.int32) * np.int32(span), mode="clip")
    near = np.flatnonzero((run >= 0) & inside)
    run, flat = run.ravel(), values.ravel()
    for some in np.array_split(near, 1 + int(several[run[near]].sum()) // COMPARED):
        n = several[run[some]]
        which = np.repeat(some, n)
        column_of = column[np.arange(len(which)) + np.repeat(first[run[some]] - (np.cumsum(n) - n), n)]
        v, y = flat[which], t[column_of, which % rows]
        close = np.abs(v - y) <= tolerance * np.maximum(np.maximum(np.abs(v), np.abs(y)), 1.0)
        np.add.at(hits, which[close] // rows * width + column_of[close], 1)
