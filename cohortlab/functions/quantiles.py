"""Exact linear-interpolated quantiles that stay bounded at any row count.

Spark's exact ``percentile`` keeps a value -> count map per group and merges
all of it into one task, and a merged sketch still sends one sketch per map
task to that task. Here ranks are found by counting, in the same few steps for
every input:

1. one aggregate per column: least and largest value;
2. ``LEVELS`` passes that count values per group and bin of the range still in
   question (``BINS`` equal bins of ``sign(v) log(1 + |v|)``, each with its own
   least and largest value). A running count over a group's bins, at most
   ``BINS`` rows, shows which bins hold the wanted ranks; only those are divided
   again;
3. the distinct values of the last bins with their counts, and a running count
   over each bin's values.

Counts combine before every shuffle and are keyed by (group, column, bin), so
a group or a value that holds most of the rows is spread like any other. For
groups the distinct values of each are counted first, in one shuffle keyed by
value; without groups no value is sent anywhere before its bin is known to
matter. There is one row per value and column in each pass, however many
probabilities are asked for. The tables between the passes have two rows per
column and probability at most and are written to the shared folder; for groups
Spark knows their sizes from the files and chooses the joins, without groups
bounds and wanted bins go into the scans as literals.

``method="approx"`` returns the sketch value directly; ``method="spark"`` uses
the built-in exact ``percentile`` (fine for small inputs).

Interpolation is ``v_lo + (pos - floor(pos)) * (v_hi - v_lo)`` with
``pos = p (n-1)``, the definition used by pandas and SQL ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.session import discard, staged

DEFAULT_ACCURACY = 100_000
BINS = 1 << 12  # of a dozen columns, these fit the 2^16 rows of Spark's in-code hash map
LEVELS = 1


def _long_values(df: DataFrame, by: list[str], columns: Sequence[str]) -> DataFrame:
    """(by..., column, v) for every non-null, non-NaN value; stays map-side."""
    items = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
        for c in columns
    ])
    out = df.select(*by, F.explode(items).alias("_x"))
    out = out.select(*by, F.col("_x.column").alias("column"), F.col("_x.v").alias("v"))
    return out.filter(F.col("v").isNotNull() & ~F.isnan("v"))


def _ranges(vals: DataFrame) -> DataFrame:
    """(column, path, lo, hi) of the whole column: one row per column."""
    return vals.groupBy("column").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).withColumn("path", F.lit(0).cast("long"))


def _scale(v: Column) -> Column:
    return F.signum(v) * F.log1p(F.abs(v))


def _within(vals: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Values that lie in a range of ``table``. The ranges of a group do not overlap; where
    ``vals`` has no ``path`` yet, the bounds tell in which one a value lies."""
    if "path" in vals.columns:
        return vals.join(table, [*on, "path"])
    return vals.join(table, on).filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))


def _into_bins(vals: DataFrame, table: DataFrame, on: list[str], keys: list[str], bins: int) -> DataFrame:
    """Values of the ranges in ``table`` with ``path`` extended by their bin there."""
    low, high = _scale(F.col("lo")), _scale(F.col("hi"))
    table = table.withColumns({"low": low, "per": F.coalesce(bins / F.when(high > low, high - low), F.lit(0.0))})
    nth = F.least(F.floor((_scale(F.col("v")) - F.col("low")) * F.col("per")), F.lit(bins - 1))
    return _within(vals, table, on).select(
        *keys, (F.col("path") * bins + nth).cast("long").alias("path"), "v", "c", F.col("path").alias("within"))


def _bin_counts(inside: DataFrame, by: list[str]) -> DataFrame:
    """Counts and bounds only: buffers of fixed size, so the aggregate is by hash."""
    return inside.groupBy(*by).agg(F.sum("c").alias("count"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def _with_ranks(counts: DataFrame, table: DataFrame, keys: list[str], path: str) -> DataFrame:
    return counts.join(table.select(*keys, F.col("path").alias(path), "n", "wanted"), [*keys, path])


def _ranks(counts: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Adds the number ``n`` of a group's values and the ranks to find."""
    counts = counts.withColumn("n", F.sum("count").over(Window.partitionBy(*keys)))
    pos = [F.lit(p) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in pos for f in (F.floor, F.ceil)]))
    return counts.withColumn("wanted", F.transform(ranks, lambda r: F.struct(r.alias("rank"), r.alias("rest"))))


def _wanted_here(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows of ``counts`` in which a wanted rank falls, with the ranks counted from their start."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = counts.withColumn("begin", F.sum("count").over(w) - F.col("count"))
    inside = F.filter("wanted", lambda x: (x["rest"] >= F.col("begin")) & (x["rest"] < F.col("begin") + F.col("count")))
    moved = F.transform(inside, lambda x: F.struct(x["rank"].alias("rank"), (x["rest"] - F.col("begin")).alias("rest")))
    return begun.withColumn("wanted", moved).filter(F.size("wanted") > 0).drop("begin")


def _exact(df: DataFrame, by: list[str], columns: Sequence[str], probs: list[float], bins: int, levels: int) -> DataFrame:
    keys = [*by, "column"]
    tables = []

    def between(t: DataFrame) -> DataFrame:
        # read twice by the next step: counted once, not again for each use
        tables.append(staged(t, "quantile-bins"))
        return tables[-1] if by else F.broadcast(tables[-1])

    vals = _long_values(df, by, columns)
    if by:
        # distinct values of each group with their counts: a group or value that most
        # rows have is collapsed before the shuffle, the rest is spread by value
        vals = staged(vals.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c")), "quantile-values")
        tables.append(vals)
    else:
        vals = vals.withColumn("c", F.lit(1).cast("long"))
    ranges = F.broadcast(_ranges(vals))
    inside = _into_bins(vals, ranges, ["column"], keys, bins)
    counts = _ranks(_bin_counts(inside, [*keys, "path"]), keys, probs)
    table = between(_wanted_here(counts, keys, "path").select(*keys, "path", "n", "lo", "hi", "wanted"))
    # a broadcast table finds a value's range by its bounds; where the values of groups may be
    # shuffled, the bins found so far are part of the key, so that no group meets in one task
    for _ in range(levels - 1):
        vals = inside.select(*keys, "path", "v", "c") if by else vals
        inside = _into_bins(vals, table.drop("n", "wanted"), keys, keys, bins)
        counts = _with_ranks(_bin_counts(inside, [*keys, "within", "path"]), table, keys, "within")
        table = between(_wanted_here(counts, [*keys, "within"], "path").select(*keys, "path", "n", "lo", "hi", "wanted"))
    vals = inside.select(*keys, "path", "v", "c") if by else vals
    last = _within(vals, table.drop("n", "wanted"), keys)
    last = last.groupBy(*keys, "path", "v").agg(F.sum("c").alias("count"))
    out = staged(_values_at_ranks(last, table, keys, probs), "quantiles")
    discard(tables)
    return out


def _values_at_ranks(last: DataFrame, table: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """(keys..., prob, value) from the counts of the values in the last bins."""
    found = _wanted_here(_with_ranks(last, table, keys, "path"), [*keys, "path"], "v").select(*keys, "n", "v", F.explode("wanted.rank").alias("rank"))
    # a group has two ranks per probability at most
    ranked = found.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    each = ranked.select(*keys, "n", "at", F.explode(F.array(*[F.lit(p) for p in probs])).alias("prob"))
    pos = F.col("prob") * (F.col("n") - 1)
    low, high = (F.element_at("at", f(pos).cast("long")) for f in (F.floor, F.ceil))
    value = F.when(low == high, low).otherwise(low + (pos - F.floor(pos)) * (high - low))
    return each.select(*keys, "prob", value.alias("value"))


def _exact_whole(df: DataFrame, columns: Sequence[str], probs: list[float], bins: int) -> DataFrame:
    """``_exact`` without groups and with one level of bins, in three scans without a join of
    the values: bounds, then wanted bins, are literals (two numbers a column, and two bins at
    most a column and probability), and only values of wanted bins leave the last scan."""
    values = [F.when(~F.isnan(v), v) for v in (F.col(c).cast("double") for c in columns)]
    seen = df.agg(*[f(v).alias(f"{at}{i}") for i, v in enumerate(values) for at, f in (("lo", F.min), ("hi", F.max))]).first()
    bounds = [(seen[f"lo{i}"], seen[f"hi{i}"]) for i in range(len(values))]
    if all(low is None for low, _ in bounds):
        return df.sparkSession.createDataFrame([], "column string, prob double, value double")
    vals = df.select(F.posexplode(F.array(*values)).alias("column", "v")).filter(F.col("v").isNotNull())
    # a column without values has no row, whatever its bounds
    lows = F.get(F.array(*[_scale(F.lit(0.0 if x is None else x)) for x, _ in bounds]), F.col("column"))
    highs = F.get(F.array(*[_scale(F.lit(0.0 if x is None else x)) for _, x in bounds]), F.col("column"))
    per = F.coalesce(bins / F.when(highs > lows, highs - lows), F.lit(0.0))
    nth = F.least(F.floor((_scale(F.col("v")) - lows) * per), F.lit(bins - 1))
    # column and bin in one number: the map of counts is the cost of this scan
    binned = vals.select((F.col("column") * F.lit(bins).cast("long") + nth).alias("key"), "v")
    path = F.col("key") % bins
    parted = [((F.col("key") - path) / bins).cast("int").alias("column"), path.alias("path")]
    counts = binned.groupBy("key").agg(F.count(F.lit(1)).alias("count")).select(*parted, "count")
    found = _wanted_here(_ranks(counts, ["column"], probs), ["column"], "path").select("column", "path", "n", "wanted")
    table = staged(found, "quantile-bins")
    asked = [r["column"] * bins + r["path"] for r in table.select("column", "path").collect()]
    last = binned.filter(F.col("key").isin(asked)).groupBy("key", "v").agg(F.count(F.lit(1)).alias("count"))
    last = last.select(*parted, "v", "count")
    names = F.array(*[F.lit(c) for c in columns])
    out = _values_at_ranks(last, F.broadcast(table), ["column"], probs)
    out = staged(out.withColumn("column", F.element_at(names, F.col("column") + 1)), "quantiles")
    discard([table])
    return out


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   by: Sequence[str] = (), method: str = "exact", accuracy: int = DEFAULT_ACCURACY,
                   bins: int = BINS, levels: int = LEVELS) -> DataFrame:
    """Quantiles of non-null values: one row per (by..., column, prob) with a value.

    Groups with a NULL key are left out (they have no group). Columns whose
    values are all NULL give no row. ``exact`` reads ``df``, or for
    groups its distinct values, ``levels + 2`` times.
    """
    by = list(by)
    probs = list(dict.fromkeys(float(p) for p in probs))
    base = df
    for b in by:
        base = base.filter(F.col(b).isNotNull())
    if method in ("approx", "spark"):
        aggs = []
        for i, c in enumerate(columns):
            v = F.col(c).cast("double")
            v = F.when(~F.isnan(v), v)
            aggs.append((F.percentile_approx(v, probs, accuracy) if method == "approx"
                         else F.percentile(v, probs)).alias(f"_q{i}"))
        agg = base.groupBy(*by).agg(*aggs)
        rows = [F.struct(F.lit(c).alias("column"), F.lit(p).alias("prob"),
                         F.element_at(f"_q{i}", j + 1).alias("value"))
                for i, c in enumerate(columns) for j, p in enumerate(probs)]
        out = agg.select(*by, F.explode(F.array(*rows)).alias("_r"))
        return out.select(*by, "_r.column", "_r.prob", "_r.value").filter(F.col("value").isNotNull())
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    if not 2 <= bins ** levels < 2 ** 62:
        raise ValueError("the bins of all levels are numbered by a long")
    if not by and levels == 1:
        return _exact_whole(base, columns, probs, bins)
    return _exact(base, by, columns, probs, bins, levels)


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    method: str = "exact", accuracy: int = DEFAULT_ACCURACY) -> dict:
    """Global quantiles as ``{(column, prob): value}`` (missing when no values)."""
    tbl = quantile_table(df, columns, probs, method=method, accuracy=accuracy)
    return {(r["column"], float(r["prob"])): r["value"] for r in tbl.collect()}


def weighted_quantile_table(df: DataFrame, value: str, weight: str, prob: float,
                            by: Sequence[str] = ()) -> DataFrame:
    """Quantile of ``value`` repeated ``weight`` times, per group: (by..., value).

    For small count tables (one row per distinct value). Same interpolation as
    ``quantile_table``; Spark's weighted ``percentile`` rounds differently.
    """
    by = list(by)
    d = df.filter(F.col(value).isNotNull() & (F.col(weight) > 0)).select(
        *by, F.col(value).cast("double").alias("v"), F.col(weight).cast("long").alias("w"))
    d = d.groupBy(*by, "v").agg(F.sum("w").alias("w"))
    w = Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_end", F.sum("w").over(w) - 1).withColumn("_start", F.col("_end") - F.col("w") + 1)
    d = d.withColumn("n", F.sum("w").over(Window.partitionBy(*by)))
    pos = F.lit(float(prob)) * (F.col("n") - 1)
    d = d.withColumn("_fl", F.floor(pos)).withColumn("_ce", F.ceil(pos))

    def pick(rank):
        return F.max(F.when((F.col("_start") <= F.col(rank)) & (F.col("_end") >= F.col(rank)), F.col("v")))

    r = d.groupBy(*by, "n").agg(pick("_fl").alias("lo"), pick("_ce").alias("hi"))
    frac = pos - F.floor(pos)
    return r.select(*by, F.when(F.col("lo") == F.col("hi"), F.col("lo"))
                    .otherwise(F.col("lo") + frac * (F.col("hi") - F.col("lo"))).alias("value"))


def weighted_quantile(df: DataFrame, value: str, weight: str, prob: float) -> float | None:
    row = weighted_quantile_table(df, value, weight, prob).first()
    return None if row is None else row["value"]
