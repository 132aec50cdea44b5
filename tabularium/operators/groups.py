"""Group statistics, ranked groups, histograms and densities.

Where a group aggregate goes back to the rows, it is stored first: its measured size lets Spark
broadcast it and leave the rows in place, or shuffle both sides when there are too many groups.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.columns import scale01
from tabularium.operators.order_stats import join_groups, quantiles
from tabularium.session import stored


def value_counts(df: DataFrame, column: str, with_nulls: bool = True) -> DataFrame:
    source = df if with_nulls else df.filter(F.col(column).isNotNull())
    return source.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def group_means(df: DataFrame, group: str, value: str, name: str = "mean") -> DataFrame:
    return df.groupBy(group).agg(F.avg(value).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_count(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns])


def count_and_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """Row count and mean per group in one aggregation (instead of merging two)."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(value)).alias("mean")
    )


def merge_on_group(left: DataFrame, right: DataFrame, group: str) -> DataFrame:
    return left.join(right, group)


def top_groups(df: DataFrame, by: str, tie: str, k: int = 5, lowest: bool = False) -> DataFrame:
    """The ``k`` first groups by a statistic with the group name as tie-break."""
    order = F.col(by).asc() if lowest else F.col(by).desc()
    return df.orderBy(order, F.col(tie).asc()).limit(k)


def top_dense_groups(
    df: DataFrame, group: str, value: str, min_rows: int = 100, k: int = 5
) -> DataFrame:
    """Groups with more than ``min_rows`` rows, the ``k`` with the highest mean."""
    stats = count_and_mean(df, group, value).filter(F.col("n") > min_rows)
    return top_groups(stats, "mean", group, k)


def drop_allnull_groups(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows of the groups in which ``value`` is known at least once."""
    known = df.groupBy(group).agg(F.count(value).alias("_known")).filter("_known > 0")
    return _rows_of_groups(df, known, group)


def drop_rare_groups(df: DataFrame, group: str, min_rows: int) -> DataFrame:
    """Rows of the groups with at least ``min_rows`` rows."""
    kept = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
    return _rows_of_groups(df, kept, group)


def _rows_of_groups(df: DataFrame, kept: DataFrame, group: str) -> DataFrame:
    """Rows whose group is in ``kept``; the NULL group is a group like any other."""
    names = stored(kept.select(F.col(group).alias("_kept_group")))
    return df.join(names, df[group].eqNullSafe(names["_kept_group"]), "left_semi")


def with_group_count(df: DataFrame, group: str, name: str = "group_n") -> DataFrame:
    """The size of the own group as a column; a join with the counts, so that no task has to
    hold the rows of a large group."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias(name))
    return join_groups(df, stored(counts), [group])


def modes(df: DataFrame, groups: list[str], column: str) -> DataFrame:
    """Most frequent value, the smallest one on ties; overall when ``groups`` is empty."""
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*groups, column)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted.groupBy(*groups).agg(
        F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias("mode")
    )


def fill_group_mode(df: DataFrame, group: str, column: str) -> DataFrame:
    mode = stored(modes(df, [group], column))
    return (
        df.join(mode, group, "left")
        .withColumn(column, F.coalesce(column, "mode"))
        .drop("mode")
    )


def melt(df: DataFrame, columns: list[str], ids: list[str] | None = None) -> DataFrame:
    """Long form ``(ids, column, value)`` of numeric columns."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    return df.select(*(ids or []), F.inline(pairs))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample sd, min, quartiles and max per column."""
    long = melt(df, columns)
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("sd"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantiles(long, ["column"], "value", [0.25, 0.5, 0.75]).select(
        "column",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
    )
    return moments.join(quartiles, "column", "left")


def extent(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def break_points(df: DataFrame, column: str, parts: int = 10) -> DataFrame:
    """Equal-width break points from the minimum to the maximum of a column."""
    return extent(df, column).select(
        F.explode(F.sequence(F.lit(0), F.lit(parts))).alias("i"), "low", "high"
    ).select("i", (F.col("low") + F.col("i") * (F.col("high") - F.col("low")) / parts).alias("at"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width counts ``(bin, bin_lo, bin_hi, n)``; the last bin is closed, empty bins stay."""
    value = F.col(column)
    limits = extent(df, column)
    low, high = limits.select("low").scalar(), limits.select("high").scalar()
    width = (high - low) / bins
    placed = (
        df.select(value.cast("double").alias("v"))
        .filter("v IS NOT NULL")
        .select(
            F.least(
                F.coalesce(F.floor(F.try_divide(F.col("v") - low, width)), F.lit(0)).cast("int"),
                F.lit(bins - 1),
            ).alias("bin")
        )
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    edges = limits.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        "low",
        ((F.col("high") - F.col("low")) / bins).alias("w"),
    )
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("w")).alias("bin_lo"),
        (F.col("low") + (F.col("bin") + 1) * F.col("w")).alias("bin_hi"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def box_stats(df: DataFrame, group: str, value: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (last values within the fences) and outlier count per group."""
    q = quantiles(df, [group], value, [0.25, 0.5, 0.75]).select(
        group,
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
    )
    v = F.col("_v")
    reach = (F.col("q3") - F.col("q1")) * whisker
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    # The distinct values with their counts carry all that is needed.
    counted = (
        df.select(group, F.col(value).cast("double").alias("_v"))
        .filter("_v IS NOT NULL")
        .groupBy(group, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        join_groups(counted, q, [group])
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_lo"),
            F.max(F.when(inside, v)).alias("whisker_hi"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_n"))).cast("long").alias("outliers"),
        )
    )


def bandwidths(df: DataFrame, group: str, value: str) -> DataFrame:
    """Default Gaussian bandwidth 0.9 * min(sd, IQR / 1.34) * n^-0.2 per group.

    Without spread (one distinct value) the size of that value, or 1, takes the place of the spread.
    """
    spread = quantiles(df, [group], value, [0.25, 0.75])
    moments = df.groupBy(group).agg(
        F.count(value).alias("n"),
        F.stddev(value).alias("sd"),
        F.min(value).cast("double").alias("low"),
        F.max(value).cast("double").alias("high"),
    )
    iqr = (F.col("q")[1] - F.col("q")[0]) / 1.34
    size = F.abs("low")  # of a constant group, whose spread is 0
    narrow = (
        F.when(F.least("sd", iqr) > 0, F.least("sd", iqr))
        .when(F.col("sd") > 0, F.col("sd"))
        .when(size > 0, size)
        .otherwise(1.0)
    )
    return join_groups(moments, spread, [group]).select(
        group, "n", "low", "high", (F.lit(0.9) * narrow * F.pow("n", F.lit(-0.2))).alias("bw")
    )


def density_grid(df: DataFrame, group: str, value: str, points: int = 64, cut: float = 3.0):
    """Gaussian kernel density per group on a grid from low - cut*bw to high + cut*bw.

    Every row is shared linearly between its two neighbouring grid points (the usual binned
    estimate), so the pass over the rows ends in at most ``points`` weights per group and only
    those weights meet the grid.
    """
    # One row per group, used for the rows and again for the grid: written once.
    bw = stored(bandwidths(df, group, value).filter("n > 0"))
    start = F.col("low") - cut * F.col("bw")
    step = (F.col("high") - F.col("low") + 2 * cut * F.col("bw")) / (points - 1)
    scale = bw.select(group, "n", "bw", start.alias("start"), step.alias("step"))
    pos = (F.col("v") - F.col("start")) / F.col("step")
    left = F.floor(pos)
    shared = (
        df.select(group, F.col(value).cast("double").alias("v"))
        .filter("v IS NOT NULL")
        .transform(lambda d: join_groups(d, scale, [group]))
        .select(
            group,
            F.inline(
                F.array(
                    F.struct(left.cast("int").alias("j"), (1 - (pos - left)).alias("w")),
                    F.struct((left + 1).cast("int").alias("j"), (pos - left).alias("w")),
                )
            ),
        )
        .groupBy(group, "j")
        .agg(F.sum("w").alias("w"))
    )
    weights = shared.groupBy(group).agg(F.collect_list(F.struct("j", "w")).alias("ws"))
    kernel = F.aggregate(
        "ws",
        F.lit(0.0),
        lambda acc, s: acc
        + s["w"]
        * F.exp(-0.5 * F.pow((F.col("i") - s["j"]) * F.col("step") / F.col("bw"), F.lit(2.0))),
    )
    return (
        join_groups(weights, scale, [group])
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
        .select(
            group,
            "i",
            (F.col("start") + F.col("i") * F.col("step")).alias("at"),
            (kernel / (F.col("n") * F.col("bw") * F.lit(2.5066282746310002))).alias("density"),
        )
    )


def correlation_matrix(
    df: DataFrame, columns: list[str], pairwise: bool = False, absolute: bool = False
) -> DataFrame:
    """Pearson correlation in long form ``(a, b, r)``, all pairs in one aggregation.

    Rows with any NULL are left out, or only the NULLs of the pair with ``pairwise``; ``absolute``
    correlates the absolute values of the columns.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    source = df.select(*[(F.abs(v) if absolute else v).alias(c) for c, v in values.items()])
    if not pairwise:
        source = source.na.drop()
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    row = source.agg(*[F.corr(columns[i], columns[j]).alias(f"r{i}_{j}") for i, j in pairs])
    cells = [
        F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in columns
    ]
    for i, j in pairs:
        for a, b in ((i, j), (j, i)):
            cells.append(
                F.struct(
                    F.lit(columns[a]).alias("a"),
                    F.lit(columns[b]).alias("b"),
                    F.col(f"r{i}_{j}").alias("r"),
                )
            )
    return row.select(F.inline(F.array(*cells)))


def feature_rollup(df: DataFrame) -> DataFrame:
    """Per neighbourhood totals over the nested ``avgbedrooms`` array, without a shuffle."""
    totals = F.transform("avgbedrooms", lambda x: x["total"])
    flats = F.aggregate("avgbedrooms", F.lit(0).cast("long"), lambda a, x: a + x["total"])
    rooms = F.aggregate(
        "avgbedrooms", F.lit(0).cast("long"), lambda a, x: a + x["total"] * x["bedrooms"]
    )
    return df.select(
        "*",
        F.array_max(totals).alias("most"),
        F.array_min(totals).alias("least"),
        flats.alias("flats"),
        rooms.alias("rooms"),
        F.try_divide(rooms, flats).alias("mean_bedrooms"),
    )


def bar_colours(df: DataFrame) -> DataFrame:
    """One row per bar: most frequent red, least frequent blue, others the fixed green."""
    return df.select("name", "most", "least", F.inline("avgbedrooms")).select(
        "name",
        "bedrooms",
        "total",
        F.when(F.col("total") == F.col("most"), "red")
        .when(F.col("total") == F.col("least"), "blue")
        .otherwise("#93CAAE")
        .alias("colour"),
    )


def price_colours(df: DataFrame, column: str = "avgprice") -> DataFrame:
    """Position of each value between the extremes (NULL red), and a text with a fallback."""
    limits = extent(df, column)
    low, high = limits.select("low").scalar(), limits.select("high").scalar()
    return df.select(
        "*",
        scale01(column, low, high).alias("position"),
        F.when(F.col(column).isNull(), "red").otherwise("scale").alias("fill"),
        F.when(F.col(column).isNull(), "Sin datos")
        .otherwise(F.format_string("%.0f Eur", F.col(column)))
        .alias("caption"),
    )


def quantile_table(df: DataFrame, group: str, value: str, points: int = 99) -> DataFrame:
    """Sample quantiles beside standard normal ones, with the line through the quartiles."""
    shares = [(i + 0.5) / points for i in range(points)]
    normal = NormalDist()
    theory = F.array(*[F.lit(normal.inv_cdf(s)) for s in shares])
    z1, z3 = normal.inv_cdf(0.25), normal.inv_cdf(0.75)
    q = quantiles(df, [group], value, [0.25, 0.75, *shares])
    slope = (F.col("q")[1] - F.col("q")[0]) / (z3 - z1)
    lined = q.select(
        group, "q", slope.alias("slope"), (F.col("q")[0] - slope * z1).alias("intercept")
    )
    rows = F.arrays_zip(
        F.sequence(F.lit(1), F.lit(points)).alias("i"),
        theory.alias("theoretical"),
        F.slice("q", 3, points).alias("sample"),
    )
    return lined.select(group, "slope", "intercept", F.inline(rows)).select(
        group,
        "i",
        "theoretical",
        "sample",
        (F.col("intercept") + F.col("slope") * F.col("theoretical")).alias("line"),
    )


def proportion(df: DataFrame, column: str, value) -> DataFrame:
    """Count and share (percent, two decimals) of the rows with a given value."""
    return df.agg(
        F.count_if(F.col(column) == value).alias("hits"), F.count(F.lit(1)).alias("n")
    ).select(
        "hits", "n", F.round(F.try_divide(F.col("hits") * 100.0, F.col("n")), 2).alias("percent")
    )


def cumulative_share(df: DataFrame, order: str, value: str) -> DataFrame:
    """Share and running share of ``value``; meant for a table with one row per component."""
    ordered = Window.partitionBy(F.lit(0)).orderBy(order)
    total = F.sum(value).over(Window.partitionBy(F.lit(0)))
    return df.select(
        "*",
        (F.col(value) / total).alias("share"),
        (F.sum(value).over(ordered) / total).alias("running_share"),
    )
