"""Hypothesis tests computed from group aggregates.

The table of group aggregates (one row per group) is stored before totals are taken over it, so
the rows themselves are read once.
"""

from __future__ import annotations

from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions import distributions as dist
from tabularium.functions.normal import log_normal_cdf
from tabularium.operators.groups import proportion
from tabularium.operators.order_stats import global_row_number, join_groups, mid_ranks, running_counts
from tabularium.session import stored


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """n, mean and sum of squared deviations per group, NULL values left out."""
    v = F.col(value).cast("double")
    return (
        df.filter(v.isNotNull())
        .groupBy(group)
        .agg(
            F.count(v).alias("n"),
            F.avg(v).alias("mean"),
            (F.var_pop(v) * F.count(v)).alias("within"),
        )
    )


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way analysis of variance: ``(df_between, df_within, ss_between, ss_within, f, p)``."""
    stats = stored(group_moments(df, group, value))
    grand = stats.agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("g")).scalar()
    sums = stats.agg(
        (F.count(F.lit(1)) - 1).alias("df_between"),
        (F.sum("n") - F.count(F.lit(1))).alias("df_within"),
        F.sum(F.col("n") * F.pow(F.col("mean") - grand, F.lit(2.0))).alias("ss_between"),
        F.sum("within").alias("ss_within"),
    )
    f = F.try_divide(
        F.col("ss_between") / F.col("df_between"), F.col("ss_within") / F.col("df_within")
    )
    return sums.withColumn("f", f).withColumn("p", dist.f_p_value("f", "df_between", "df_within"))


def kruskal_wallis(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rank test with tie correction: ``(df, h, p)``."""
    ranked = mid_ranks(df, value, [group])
    ties = F.col("ties").cast("double")
    per_group = stored(
        ranked.groupBy(group).agg(
            F.sum("n").cast("double").alias("n"),
            F.sum(F.col("n") * F.col("rank")).alias("rank_sum"),
            F.sum(F.col("n") * (ties * ties - 1.0)).alias("tie_part"),
        )
    )
    total = per_group.agg(F.sum("n").alias("N")).scalar()
    gap = F.col("rank_sum") / F.col("n") - (total + 1.0) / 2.0
    sums = per_group.agg(
        (F.count(F.lit(1)) - 1).alias("df"),
        F.sum("n").alias("N"),
        F.sum(F.col("n") * gap * gap).alias("spread"),
        F.sum("tie_part").alias("tie_part"),
    )
    n = F.col("N")
    h = (F.lit(12.0) * F.col("spread") / (n * (n + 1.0))) / (
        1.0 - F.col("tie_part") / (n * n * n - n)
    )
    return sums.select("df", h.alias("h")).withColumn("p", dist.chi2_p_value("h", "df"))


def tukey_pairs(df: DataFrame, group: str, value: str, level: float = 0.95) -> DataFrame:
    """All pairs of groups: difference of means, interval and adjusted p-value."""
    return _pairs_of(stored(group_moments(df, group, value)), group, level)


def tukey_to_control(
    df: DataFrame, group: str, value: str, control: str, level: float = 0.95
) -> DataFrame:
    """Every other group against one: difference of means, interval, adjusted p-value; one row per group."""
    stats = stored(group_moments(df, group, value))
    own = stats.filter(F.col(group) == control).first()
    if own is None:
        raise ValueError(f"no values in group {control}")
    pooled = stats.agg(
        F.count(F.lit(1)).cast("double").alias("k"), F.sum("n").alias("n"), F.sum("within").alias("w")
    ).first()
    k, dof = float(pooled["k"]), float(pooled["n"] - pooled["k"])
    error = F.sqrt(F.lit(pooled["w"] / dof / 2.0) * (1.0 / F.col("n") + F.lit(1.0 / own["n"])))
    diff = F.col("mean") - F.lit(own["mean"])
    others = stats.filter(~F.col(group).eqNullSafe(F.lit(control))).select(
        F.lit(control).alias("control"), group, diff.alias("diff"), error.alias("error"),
        F.lit(k).alias("k"), F.lit(dof).alias("dof"),
    )
    width = dist.tukey_width(F.lit(level), "k", "dof") * F.col("error")
    p = dist.tukey_p_value(F.abs("diff") / F.col("error"), "k", "dof")
    judged = others.withColumns({"width": width, "p_adj": p})
    low, high = F.col("diff") - F.col("width"), F.col("diff") + F.col("width")
    return judged.select("control", group, "diff", low.alias("low"), high.alias("high"), "p_adj")


def _pairs_of(stats: DataFrame, group: str, level: float) -> DataFrame:
    """Tukey comparisons from the group moments.

    The pairing works on the table of group moments (one row per group): every group lists the
    numbers of its partners and meets them in an equi-join.
    """
    pooled = stats.agg(
        F.count(F.lit(1)).cast("double").alias("k"),
        (F.sum("n") - F.count(F.lit(1))).cast("double").alias("dof"),
        F.sum("within").alias("within"),
    )
    k = pooled.select("k").scalar()
    dof = pooled.select("dof").scalar()
    within = pooled.select("within").scalar()
    numbered = global_row_number(stats, [F.col(group).asc()], "i")
    left = numbered.filter(F.col("i") > 1).select(
        F.col(group).alias("group_b"),
        F.col("n").alias("n_b"),
        F.col("mean").alias("mean_b"),
        F.explode(F.sequence(F.lit(1), F.col("i") - 1)).alias("j"),
    )
    right = numbered.select(
        F.col("i").alias("j"),
        F.col(group).alias("group_a"),
        F.col("n").alias("n_a"),
        F.col("mean").alias("mean_a"),
    )
    error = F.sqrt(
        F.col("within") / F.col("dof") / 2.0 * (1.0 / F.col("n_a") + 1.0 / F.col("n_b"))
    )
    return (
        left.join(right, "j")
        .withColumns({"k": k, "dof": dof, "within": within})
        .select(
            "group_a",
            "group_b",
            (F.col("mean_b") - F.col("mean_a")).alias("diff"),
            error.alias("error"),
            "k",
            "dof",
        )
        .withColumn("width", dist.tukey_width(F.lit(level), "k", "dof") * F.col("error"))
        .select(
            "group_a",
            "group_b",
            "diff",
            (F.col("diff") - F.col("width")).alias("low"),
            (F.col("diff") + F.col("width")).alias("high"),
            dist.tukey_p_value(F.abs("diff") / F.col("error"), "k", "dof").alias("p_adj"),
        )
    )


def group_similarity(df: DataFrame, group: str, value: str) -> DataFrame:
    """Adjusted p-values as a symmetric matrix in long form, 1 on the diagonal, with 1 - p."""
    stats = stored(group_moments(df, group, value))
    pairs = _pairs_of(stats, group, 0.95).select(
        "group_a", "group_b", F.round("p_adj", 4).alias("value")
    )
    both = pairs.select(
        F.inline(
            F.array(
                F.struct("group_a", "group_b", "value"),
                F.struct(
                    F.col("group_b").alias("group_a"), F.col("group_a").alias("group_b"), "value"
                ),
            )
        )
    )
    diagonal = stats.select(
        F.col(group).alias("group_a"), F.col(group).alias("group_b"), F.lit(1.0).alias("value")
    )
    return both.unionByName(diagonal).withColumn("distance", 1.0 - F.col("value"))


def normality(df: DataFrame, group: str, value: str) -> DataFrame:
    """Jarque-Bera test per group from skewness and excess kurtosis."""
    stats = (
        df.filter(F.col(value).isNotNull())
        .groupBy(group)
        .agg(
            F.count(value).alias("n"),
            F.skewness(value).alias("skewness"),
            F.kurtosis(value).alias("kurtosis"),
        )
    )
    jb = F.col("n") / 6.0 * (F.pow("skewness", F.lit(2.0)) + F.pow("kurtosis", F.lit(2.0)) / 4.0)
    return stats.withColumn("jb", jb).withColumn("p", F.exp(-F.col("jb") / 2.0))


# P-value of the adjusted statistic when mean and deviation come from the rows (upper limit of
# the statistic, then the terms of the exponent; the first two rows give 1 - p).
AD_P = (
    (0.2, -13.436, 101.14, -223.73),
    (0.34, -8.318, 42.796, -59.938),
    (0.6, 0.9177, -4.279, -1.38),
    (10.0, 1.2937, -5.709, 0.0186),
)
AD_LEAST = 3.7e-24


def anderson_darling(df: DataFrame, group: str, value: str) -> DataFrame:
    """Anderson-Darling test of each group against the normal law fitted to it: ``(group, n, a2, p)``.

    Every distinct value gets its place in the order of its group from running counts, so no group is
    sorted in one task. A group with fewer than two values, or with one value only, has no statistic.
    """
    counted = running_counts(df.select(group, F.col(value).cast("double").alias(value)), [group], value)
    counted = stored(counted)
    n, v = F.col("n").cast("double"), F.col("value")
    means = counted.groupBy(group).agg((F.sum(n * v) / F.sum(n)).alias("mean"), F.sum("n").alias("size"))
    means = stored(means)
    around = join_groups(counted, means, [group])
    spread = around.groupBy(group).agg(F.sum(n * F.pow(v - F.col("mean"), F.lit(2.0))).alias("square"))
    spread = stored(join_groups(means, spread, [group]))
    sd = F.when((F.col("square") > 0) & (F.col("size") > 1), F.sqrt(F.col("square") / (F.col("size") - 1)))
    z = (v - F.col("mean")) / F.col("sd")
    before, size = F.col("before").cast("double"), F.col("size").cast("double")
    # the sums of 2 i - 1 and of 2 (size - i) + 1 over the places i of equal values
    below, above = n * (2.0 * before + n), n * (2.0 * size - 2.0 * before - n)
    term = below * log_normal_cdf(z) + above * log_normal_cdf(-z)
    placed = join_groups(counted, spread.withColumn("sd", sd), [group])
    sums = placed.groupBy(group).agg(F.first("size").alias("n"), F.sum(term).alias("terms"))
    a2 = -F.col("n") - F.col("terms") / F.col("n")
    return sums.select(group, "n", a2.alias("a2")).withColumn("p", _ad_p_value(F.col("a2"), F.col("n")))


def _ad_p_value(a2, n):
    adjusted = a2 * (1.0 + 0.75 / n + 2.25 / (n * n))
    p = F.when(adjusted.isNull(), F.lit(None).cast("double"))
    for at, (limit, *terms) in enumerate(AD_P):
        e = F.exp(F.lit(terms[0]) + F.lit(terms[1]) * adjusted + F.lit(terms[2]) * adjusted * adjusted)
        p = p.when(adjusted < limit, 1.0 - e if at < 2 else e)
    return p.otherwise(F.lit(AD_LEAST))


def ks_normal(df: DataFrame, value: str, mean: float, sd: float) -> DataFrame:
    """Kolmogorov-Smirnov test of a column against a normal law that is given, not fitted to it."""
    clean = df.select(F.col(value).cast("double").alias(value)).na.drop()
    found = KolmogorovSmirnovTest.test(clean, value, "norm", float(mean), float(sd))
    return found.select(F.col("statistic"), F.col("pValue").alias("p"))


def proportion_interval(df: DataFrame, column: str, value, level: float = 0.90) -> DataFrame:
    """Share of a value with its exact binomial interval, all in percent."""
    share = proportion(df, column, value)
    bounds = share.withColumn(
        "b",
        dist.binomial_bounds(
            F.col("hits").cast("double"), F.col("n").cast("double"), F.lit(level)
        ),
    )
    return bounds.select(
        "hits", "n", "percent", (F.col("b.low") * 100).alias("low"), (F.col("b.high") * 100).alias("high")
    )
