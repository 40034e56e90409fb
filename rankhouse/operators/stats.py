"""Global and per-group statistics that stay balanced when one value or group dominates the data.

Aggregates that come back as one row are read through a scalar subquery. Everything keyed joins back by equality and
is left to adaptive execution, which broadcasts the group side only when its measured size allows it and otherwise
sort-merges with skew splitting."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankhouse.sources.staging import materialize


def _stride(df: DataFrame, bands: int | None) -> int:
    """Bands are a square, at least ``bands``, by default the session's shuffle partitions: as many tasks can rank at once."""
    wanted = bands or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, math.isqrt(max(1, wanted) - 1) + 1)


def _matching(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"_{key}"])
    return condition


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys where NULL equals NULL, as in a window partition. ``stats`` is unique by the keys."""
    if not keys:
        raise ValueError("needs at least one key")
    right = stats.withColumnsRenamed({key: f"_{key}" for key in keys})
    return df.join(right, _matching(df, right, keys), "left").drop(*(f"_{key}" for key in keys))


def with_group_stats(df: DataFrame, groups: Sequence[str], stats: Mapping[str, Column], of: DataFrame | None = None) -> DataFrame:
    """Add aggregates per group, computed over ``of`` (default: the rows themselves). Unlike a window without order,
    no task sees a whole group: partial aggregates are shuffled instead of rows."""
    summary = (df if of is None else of).groupBy(*groups).agg(*(agg.alias(name) for name, agg in stats.items()))
    return attach(df, summary, groups)


def _with_weight_before(distinct: DataFrame, groups: Sequence[str], value: str, weight: str, descending: bool, bands: int | None = None) -> DataFrame:
    """Add ``before``, the total weight of the group's values ahead of this one, and ``total``, the weight of the whole
    group. Input: one row per (groups, value).

    Values are cut into bands at approximate quantiles of the distinct values, so a window holds about one band's share of
    them and the totals of the bands in front are added. The cut points only balance the work; the sums are exact."""
    stride = _stride(distinct, bands)
    bands = stride * stride
    points = ", ".join(f"{i / bands}D" for i in range(1, bands))  # as text: one expression instead of a column for each
    found = distinct.agg(F.expr(f"percentile_approx(`{value}`, array({points}), {max(10_000, 4 * bands)})").alias("fine"))
    cuts = found.select(F.struct("fine", F.filter("fine", lambda _, i: (i + 1) % stride == 0).alias("coarse"))).scalar()

    def passed(array: Column) -> Column:
        return F.size(F.filter(array, lambda cut: (cut > F.col(value)) if descending else (cut < F.col(value))))

    # Find the coarse cut first, then look at its neighbourhood only.
    if descending:
        first = stride * (stride - 1 - passed(F.col("_cuts.coarse")))
        band = bands - 1 - first - (stride - 1 - passed(F.slice("_cuts.fine", first + 1, stride - 1)))
    else:
        first = stride * passed(F.col("_cuts.coarse"))
        band = first + passed(F.slice("_cuts.fine", first + 1, stride - 1))
    band = F.when(F.col(value).isNull(), bands).otherwise(band)
    # One struct key: equal also where fields are NULL, and the join keeps the partitioning of the window.
    place = F.struct(*groups, band.alias("_band"))
    banded = distinct.withColumn("_cuts", cuts).withColumn("_place", place).drop("_cuts")
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    ahead_rows = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_place").orderBy(order).rowsBetween(*ahead_rows)
    # At most a row for each band, and one for NULL, per group.
    group = Window.partitionBy(*(F.col("_place")[g] for g in groups))
    across = group.orderBy(F.col("_place")["_band"]).rowsBetween(*ahead_rows)
    totals = (
        banded.groupBy("_place")
        .agg(F.sum(weight).alias("_weight"))
        .select("_place", F.coalesce(F.sum("_weight").over(across), F.lit(0)).alias("_offset"), F.sum("_weight").over(group).alias("total"))
    )
    placed = banded.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0))).join(totals, "_place")
    return placed.withColumn("before", F.col("_inside") + F.col("_offset")).drop("_inside", "_offset", "_place")


def with_dense_rank(
    df: DataFrame, groups: Sequence[str], value: str, name: str, bands: int | None = None, stage: Callable[[DataFrame, str], DataFrame] = materialize
) -> DataFrame:
    """``dense_rank`` by descending value within the groups, for groups of any size."""
    return with_dense_ranks(df, {name: groups}, value, bands=bands, stage=stage)


def with_dense_ranks(
    df: DataFrame,
    levels: Mapping[str, Sequence[str]],
    value: str,
    averages: Mapping[str, str] | None = None,
    bands: int | None = None,
    stage: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Add a ``dense_rank`` by descending value for each level, rank name -> its groups, coarse to fine: each level's groups include those of the
    level before. ``averages``: rank name -> name of a column for the average value of that level's group.

    The rows are read twice. First they are counted by level, group and value (grouping sets); the counts are written by ``stage``, and ranks,
    averages and frequent values all come from them: the distinct values of all levels are ranked together in one pass, band by band. Then the
    ranks are joined to the rows. A value that more rows share than a band's part of them is split: its rows are dealt out over as many parts as there
    are bands, and its ranks are repeated for each. There are fewer such values than bands."""
    names, groups = list(levels), [list(g) for g in levels.values()]
    finest, averages = groups[-1], averages or {}
    if any(set(a) - set(b) for a, b in zip(groups, groups[1:])):
        raise ValueError("each level's groups include those of the level before")
    counts = df.groupingSets([[*g, value] for g in groups], *finest, value).agg(F.grouping_id().alias("_id"), F.count(F.lit(1)).alias("_n"))
    numbers = F.create_map(*(F.lit(x) for pair in zip(_grouping_ids(groups, finest), range(len(groups))) for x in pair))
    counts = stage(counts.select(numbers[F.col("_id")].alias("_level"), *finest, value, "_n", F.lit(1).alias("_one")), "rank_counts")

    parts = _stride(df, bands) ** 2
    placed = _with_weight_before(counts, ["_level", *finest], value, "_one", descending=True, bands=bands)
    placed = placed.select("_level", *finest, value, (F.col("before") + 1).cast("int").alias("_rank"))
    if len(groups) > 1:  # all levels are ranked in one pass
        placed = stage(placed, "ranks")

    def ranks(i: int) -> DataFrame:
        return placed.where(F.col("_level") == i).select(*groups[i], value, F.col("_rank").alias(names[i]))

    found = ranks(len(groups) - 1)
    for i in reversed(range(len(groups) - 1)):
        found = attach(found, ranks(i), [*groups[i], value])
    for name, column in averages.items():
        i, known = names.index(name), F.col(value).isNotNull()
        own = counts.where(F.col("_level") == i).groupBy(*groups[i])
        mean = F.try_divide(F.sum(F.col(value) * F.col("_n")), F.sum(F.when(known, F.col("_n"))))
        found = attach(found, own.agg(mean.alias(column)), groups[i])

    key = F.xxhash64(*finest, value)
    fine = counts.where(F.col("_level") == len(groups) - 1)
    hot = fine.where(F.col("_n") * parts > fine.agg(F.sum("_n")).scalar()).agg(F.collect_list(key)).scalar()
    copies = F.when(F.array_contains("_hot", key), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    found = found.withColumn("_hot", hot).withColumn("_part", F.explode(copies)).drop("_hot")
    own = F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int")
    rows = df.withColumn("_hot", hot).withColumn("_part", F.when(F.array_contains("_hot", key), own).otherwise(0)).drop("_hot")
    return attach(rows, found, [*finest, value, "_part"]).drop("_part")


def _grouping_ids(groups: Sequence[Sequence[str]], finest: Sequence[str]) -> list[int]:
    """What ``grouping_id`` gives for each level: a bit for each column that is not grouped by, the value's always 0."""
    return [sum(1 << (len(finest) - k) for k, c in enumerate(finest) if c not in g) for g in groups]


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, value, weight): how often each value of each column occurs, NULL included."""
    values = df.select(*(F.col(c).cast("double") for c in columns)).unpivot([], list(columns), "metric", "value")
    return values.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("weight"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], bands: int | None = None) -> DataFrame:
    """(metric, quantiles array) with linear interpolation, one row per column that has a value. Works on value counts,
    so neither a frequent value nor many distinct ones meet in one task."""
    return count_quantiles(value_counts(df, columns), probabilities, bands)


def count_quantiles(counts: DataFrame, probabilities: Sequence[float], bands: int | None = None) -> DataFrame:
    """The same of value counts; NULL does not count."""
    counts = counts.where("value IS NOT NULL")
    placed = _with_weight_before(counts, ["metric"], "value", "weight", descending=False, bands=bands).withColumnRenamed("total", "n")

    def value_at(index: Column) -> Column:
        here = (F.col("before") <= index) & (index < F.col("before") + F.col("weight"))
        return F.max(F.when(here, F.col("value")))

    parts = []
    for i, q in enumerate(probabilities):
        position = (F.col("n") - 1) * F.lit(float(q))
        parts += [value_at(F.floor(position)).alias(f"lo{i}"), value_at(F.ceil(position)).alias(f"hi{i}")]
    ends = placed.groupBy("metric").agg(F.max("n").alias("n"), *parts)

    def interpolated(i: int, q: float) -> Column:
        position = (F.col("n") - 1) * F.lit(float(q))
        return F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (position - F.floor(position))

    return ends.select("metric", F.array(*(interpolated(i, q) for i, q in enumerate(probabilities))).alias("quantiles"))


def approximate_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10000) -> DataFrame:
    """Same shape from mergeable sketches in one pass; rank error at most 1/accuracy."""
    sketches = df.agg(*(F.percentile_approx(F.col(c).cast("double"), list(probabilities), accuracy).alias(c) for c in columns))
    return sketches.unpivot([], list(columns), "metric", "quantiles")


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], method: str = "exact") -> DataFrame:
    try:
        return {"exact": exact_quantiles, "approx": approximate_quantiles}[method](df, columns, probabilities)
    except KeyError:
        raise ValueError("method is 'exact' or 'approx'") from None


def means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of every column."""
    return df.agg(*(F.avg(c).alias(c) for c in columns))


def mode(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent non-NULL value, the smallest among equally frequent ones."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return counts.orderBy(F.desc("_n"), F.asc(column)).limit(1).select(column)


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The ``mode`` of every column in one row, from one pass over the rows; NULL for a column without any value."""
    counts = df.groupingSets([[c] for c in columns], *columns).agg(F.grouping_id().alias("_id"), F.count(F.lit(1)).alias("_n"))

    def best(k: int, c: str) -> Column:
        others = (1 << len(columns)) - 1 - (1 << (len(columns) - 1 - k))  # grouping_id has a bit for each column that is not grouped by
        own = (F.col("_id") == others) & F.col(c).isNotNull()
        return F.min_by(c, F.when(own, F.struct(-F.col("_n"), F.col(c)))).alias(c)

    return counts.agg(*(best(k, c) for k, c in enumerate(columns)))


def _by_metric(found: DataFrame, columns: Sequence[str], value: Column) -> Column:
    """(metric, ...) rows as a scalar subquery of one struct with a field for each column."""
    return found.agg(F.struct(*(F.max(F.when(F.col("metric") == c, value)).alias(c) for c in columns))).scalar()


def fill_values(df: DataFrame, columns: Sequence[str], strategy: str = "mean", method: str = "exact") -> Column:
    """Scalar subquery of one struct: what replaces NULL in each column; NULL for a column without any value."""
    if strategy == "mean":
        return means(df, columns).select(F.struct(*columns)).scalar()
    if strategy == "median":
        return _by_metric(quantiles(df, columns, [0.5], method), columns, F.col("quantiles")[0])
    if strategy == "mode":
        return modes(df, columns).select(F.struct(*columns)).scalar()
    raise ValueError("strategy is 'mean', 'median' or 'mode'")


def count_fill_values(counts: DataFrame, columns: Sequence[str], strategy: str = "mean") -> Column:
    """The same from value counts, so that no further pass over the rows is needed."""
    known = counts.where("value IS NOT NULL")
    if strategy == "mean":
        mean = F.sum(F.col("value") * F.col("weight")) / F.sum("weight")
        return _by_metric(known.groupBy("metric").agg(mean.alias("fill")), columns, F.col("fill"))
    if strategy == "median":
        return _by_metric(count_quantiles(counts, [0.5]), columns, F.col("quantiles")[0])
    if strategy == "mode":
        best = F.max_by("value", F.struct(F.col("weight"), -F.col("value")))
        return _by_metric(known.groupBy("metric").agg(best.alias("fill")), columns, F.col("fill"))
    raise ValueError("strategy is 'mean', 'median' or 'mode'")
