"""Tests, regression and feature queries over listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.columns import bucket_of, fixed
from tabularium.functions.normal import log_erfc_sql
from tabularium.operators import cleaning, features, groups, hypothesis, regression
from tabularium.plans.common import LISTINGS, fixed_sql, with_ctes
from tabularium.sources import shapes

_L = with_ctes(LISTINGS)


#: Mean and standard deviation of prices by hypothesis, not from the tested rows.
KNOWN_PRICE = (50_000.0, 30_000.0)


def _fixed(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: fixed(c, digits) for c in columns})


def anova(spark: SparkSession, sf: str) -> DataFrame:
    df = hypothesis.anova(shapes.listings(spark, sf), "neighbourhood", "price")
    return _fixed(df.select("df_between", "df_within", "f"), 6, "f")


def kruskal_wallis(spark: SparkSession, sf: str) -> DataFrame:
    df = hypothesis.kruskal_wallis(shapes.listings(spark, sf), "neighbourhood", "square_feet")
    return _fixed(df.select("df", "h"), 6, "h")


def tukey_pairs(spark: SparkSession, sf: str) -> DataFrame:
    df = hypothesis.tukey_pairs(shapes.listings(spark, sf), "neighbourhood", "square_feet")
    return _fixed(_fixed(df, 6, "diff"), 4, "low", "high", "p_adj")


def tukey_to_control(spark: SparkSession, sf: str) -> DataFrame:
    """Size of each neighbourhood against one of them, with interval and p-value."""
    df = hypothesis.tukey_to_control(
        shapes.listings(spark, sf), "neighbourhood", "square_feet", "Brand#1"
    )
    return _fixed(_fixed(df, 6, "diff"), 4, "low", "high", "p_adj")


def group_similarity(spark: SparkSession, sf: str) -> DataFrame:
    df = hypothesis.group_similarity(shapes.listings(spark, sf), "neighbourhood", "square_feet")
    return _fixed(df, 4, "value", "distance")


def test_p_values(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics and tail probabilities of the analysis of variance and the rank test."""
    df = shapes.listings(spark, sf)
    parts = [
        hypothesis.anova(df, "neighbourhood", "price").select(
            F.lit("anova").alias("test"), F.col("f").alias("statistic"), "p"
        ),
        hypothesis.kruskal_wallis(df, "neighbourhood", "square_feet").select(
            F.lit("kruskal_wallis").alias("test"), F.col("h").alias("statistic"), "p"
        ),
    ]
    return _fixed(parts[0].unionByName(parts[1]), 6, "statistic", "p")


def ks_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Kolmogorov-Smirnov test of the prices against a given normal law."""
    return hypothesis.ks_normal(shapes.listings(spark, sf), "price", *KNOWN_PRICE)


def normality(spark: SparkSession, sf: str) -> DataFrame:
    df = hypothesis.normality(shapes.listings(spark, sf), "property_type", "price")
    return _fixed(df, 6, "skewness", "kurtosis", "p").withColumn("jb", fixed("jb", 3))


def normality_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """Anderson-Darling test of the prices of each property type against its own normal law."""
    df = hypothesis.anderson_darling(shapes.listings(spark, sf), "property_type", "price")
    return _fixed(df, 6, "a2", "p")


def proportion_ci(spark: SparkSession, sf: str) -> DataFrame:
    return groups.proportion(shapes.listings(spark, sf), "bedrooms", 3)


def proportion_bounds(spark: SparkSession, sf: str) -> DataFrame:
    df = hypothesis.proportion_interval(shapes.listings(spark, sf), "bedrooms", 3)
    return _fixed(df.select("hits", "n", "low", "high"), 6, "low", "high")


def ols_normal_eq(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.listings(spark, sf)
    fit = regression.least_squares(df, ["square_feet", "bedrooms"], "price")
    table = regression.coefficient_table(spark, fit)
    return _fixed(table.select("term", "estimate", "std_error", "t", "r2"), 6, "r2", "t").withColumns(
        {"estimate": fixed("estimate", 5), "std_error": fixed("std_error", 5)}
    )


def ols_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Regression with a dummy-coded factor: estimates, errors, p-values, 95 % intervals."""
    table = regression.factor_regression(
        shapes.listings(spark, sf), ["accommodates", "bedrooms"], "room_type", "price"
    )
    return _fixed(table, 4, "estimate", "std_error", "t", "p", "low", "high", "r2")


def residual_table(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.house_prices(spark, sf)
    fit = regression.least_squares(df, ["living_area"], "sale_price")
    out = regression.with_residuals(df, fit, "sale_price")
    return _fixed(out.select("id", "sale_price", "fitted", "residual"), 6, "fitted", "residual")


def fitted_line(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.house_prices(spark, sf)
    fit = regression.least_squares(df, ["year_built"], "sale_price")
    line = regression.fitted_line(df, fit, "year_built", 1000)
    return _fixed(line, 6, "year_built", "fitted")


def fit_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Error metrics of the price regression per room type."""
    df = shapes.listings(spark, sf)
    fit = regression.least_squares(df, ["accommodates"], "price")
    out = regression.with_residuals(df, fit, "price")
    metrics = regression.error_metrics(out, "price", "fitted", ["room_type"])
    return metrics.select(
        "room_type", fixed("rmse", 4).alias("rmse"), fixed("r2", 6).alias("r2")
    )


def gradient_descent(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.house_prices(spark, sf)
    steps = regression.gradient_descent(
        df, ["living_area"], "sale_price", eta=0.5 / df.count(), iterations=2000
    )
    return steps.select(
        "iteration",
        fixed(F.col("w")[0], 5).alias("w0"),
        fixed(F.col("w")[1], 5).alias("w1"),
        fixed("loss", 1).alias("loss"),
    )


def _train_and_all(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    df = shapes.listings(spark, sf)
    df = df.withColumn(
        "property_type", F.when(F.col("bedrooms") != 4, F.col("property_type"))
    )
    return df.filter(bucket_of("id", 100, "split") < 80), df


def mean_mode_impute(spark: SparkSession, sf: str) -> DataFrame:
    train, whole = _train_and_all(spark, sf)
    filled = features.fit_imputer(train, ["square_feet"], ["property_type"]).apply(whole)
    return _fixed(filled.select("id", "square_feet", "property_type"), 6, "square_feet")


def target_encode(spark: SparkSession, sf: str) -> DataFrame:
    train, whole = _train_and_all(spark, sf)
    encoder = features.fit_target_encoder(train, ["property_type"], "price_cents")
    out = encoder.apply(whole, {"property_type": "encoded"})
    return _fixed(out.select("id", "property_type", "encoded"), 4, "encoded")


def standardised(spark: SparkSession, sf: str) -> DataFrame:
    train, whole = _train_and_all(spark, sf)
    scaler = features.fit_scaler(train, ["accommodates", "bedrooms"])
    out = scaler.apply(whole)
    return _fixed(out.select("id", "accommodates_z", "bedrooms_z"), 6, "accommodates_z", "bedrooms_z")


def interaction_features(spark: SparkSession, sf: str) -> DataFrame:
    out = cleaning.interactions(
        shapes.listings(spark, sf), "bedrooms", "accommodates", "score", "extra_people"
    )
    return out.select(
        "id", "bedrooms_squared", "bed_bath_rooms", fixed("lat_times_lon", 6).alias("lat_times_lon")
    )


SCORED = ["bedrooms", "accommodates", "extra_people", "score"]


def feature_scores(spark: SparkSession, sf: str) -> DataFrame:
    df = features.feature_scores(shapes.listings(spark, sf), SCORED, "price")
    return _fixed(df.select("feature", "f", "mi", "keep"), 6, "f", "mi")


def model_impute(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.listings(spark, sf)
    fit = regression.least_squares(df, ["accommodates", "price"], "square_feet")
    guess = regression.linear_value(fit.coefficients, ["accommodates", "price"])
    out = features.fill_from_prediction(df, "square_feet", guess)
    return _fixed(out.select("id", "square_feet"), 4, "square_feet")


QUERIES = {
    f.__name__: f
    for f in (
        anova,
        kruskal_wallis,
        tukey_pairs,
        tukey_to_control,
        group_similarity,
        test_p_values,
        ks_prices,
        normality,
        normality_fitted,
        proportion_ci,
        proportion_bounds,
        ols_normal_eq,
        ols_summary,
        residual_table,
        fitted_line,
        fit_errors,
        gradient_descent,
        mean_mode_impute,
        target_encode,
        standardised,
        interaction_features,
        feature_scores,
        model_impute,
    )
}

_MORE = _L.rstrip() + ",\n"
_HALF = f"({log_erfc_sql('x')} - ln(2::DOUBLE))"
_AD_P = " ".join(
    f"WHEN s < {limit} THEN {'1 - ' if at < 2 else ''}exp({a} + {b}::DOUBLE * s + {c}::DOUBLE * s * s)"
    for at, (limit, a, b, c) in enumerate(hypothesis.AD_P)
)
# The studentised range by the trapezoid rule: z over the largest of k means, s over the pooled error.
_RANGE = """,
k AS (SELECT count(*)::DOUBLE AS k, (sum(n) - count(*))::DOUBLE AS dof, sum(w) AS w FROM stats),
zs AS (SELECT z, exp(-z * z / 2) AS f, {cdf_z} AS above
  FROM (SELECT (i - 80) * 0.1::DOUBLE AS z, abs((i - 80) * 0.1::DOUBLE) / sqrt(2::DOUBLE) AS x FROM range(161) r(i))),
ss AS (SELECT s, exp((dof - 1) * ln(s) - dof * (s * s - 1) / 2) AS g
  FROM (SELECT dof, 1 + (i - 25) * 0.4::DOUBLE / sqrt(2 * dof) AS s FROM k, range(51) r(i)) WHERE s > 0),
sized AS (SELECT s, g / sum(g) OVER () AS g FROM ss),
points AS (SELECT z, s, above, k, k * f * 0.1::DOUBLE / sqrt(2 * pi()) * g AS weight FROM zs, sized, k)"""


def _cdf_sql(z: str, x: str) -> str:
    half = f"exp({log_erfc_sql(x)} - ln(2::DOUBLE))"
    return f"CASE WHEN {z} < 0 THEN {half} ELSE 1 - {half} END"


_BELOW = "sum(weight * pow(greatest(above - cdf, 0), k - 1))"
_TUKEY = (
    _RANGE.format(cdf_z=_cdf_sql("z", "x"))
    + f""",
pairs AS (SELECT a.g AS group_a, b.g AS group_b, b.m - a.m AS diff, sqrt(k.w / k.dof / 2 * (1 / a.n + 1 / b.n)) AS error
  FROM stats a JOIN stats b ON a.g <> b.g, k WHERE {{pairs}}),
placed AS (SELECT group_a, group_b, weight, above, k, z - abs(diff) / error * s AS y,
    abs(z - abs(diff) / error * s) / sqrt(2::DOUBLE) AS x FROM pairs, points),
tails AS (SELECT group_a, group_b, greatest(1 - {_BELOW}, 0) AS p
  FROM (SELECT *, {_cdf_sql('y', 'x')} AS cdf FROM placed) GROUP BY ALL),
crit AS (
  SELECT 0 AS step, 0::DOUBLE AS lo, 50::DOUBLE AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN {_BELOW} < 0.95::DOUBLE THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN {_BELOW} < 0.95::DOUBLE THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT *, {_cdf_sql('y', 'x')} AS cdf
    FROM (SELECT step, lo, hi, weight, above, k, z - (lo + hi) / 2 * s AS y,
        abs(z - (lo + hi) / 2 * s) / sqrt(2::DOUBLE) AS x FROM crit, points WHERE step < 48))
  GROUP BY step, lo, hi),
width AS (SELECT (lo + hi) / 2 AS q FROM crit WHERE step = 48),
judged AS (SELECT group_a, group_b, diff, diff - q * error AS low, diff + q * error AS high, p
  FROM pairs JOIN tails USING (group_a, group_b), width)
"""
)
_JUDGED = (
    f"{fixed_sql('diff', 6)} AS diff, {fixed_sql('low', 4)} AS low, {fixed_sql('high', 4)} AS high, "
    f"{fixed_sql('p', 4)} AS p_adj"
)
_HOUSES = """houses AS (SELECT p_partkey AS id, p_retailprice AS sale_price,
  p_size::DOUBLE AS living_area, (1950 + p_partkey % 70)::DOUBLE AS year_built FROM part)"""
_TRAIN = (
    _MORE
    + """holes AS (SELECT * REPLACE (CASE WHEN bedrooms <> 4 THEN property_type END AS property_type)
  FROM listings),
train AS (SELECT * FROM holes
  WHERE CAST('0x' || substr(md5('split' || id), 1, 8) AS BIGINT) % 100 < 80)"""
)


def _two_feature_sql(x1: str, x2: str, y: str) -> str:
    """Least squares for two features by elimination on centred cross products."""
    return f"""clean AS (SELECT {x1}::DOUBLE AS a, {x2}::DOUBLE AS b, {y}::DOUBLE AS y FROM listings
  WHERE {x1} IS NOT NULL AND {x2} IS NOT NULL AND {y} IS NOT NULL),
m AS (SELECT count(*)::DOUBLE AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my,
    count(*) * var_pop(a) AS saa, count(*) * var_pop(b) AS sbb, count(*) * var_pop(y) AS syy,
    count(*) * covar_pop(a, b) AS sab, count(*) * covar_pop(a, y) AS say,
    count(*) * covar_pop(b, y) AS sby FROM clean),
dets AS (SELECT *, saa * sbb - sab * sab AS det FROM m),
c AS (SELECT *, (sbb * say - sab * sby) / det AS ca, (saa * sby - sab * say) / det AS cb FROM dets),
r AS (SELECT *, my - ca * ma - cb * mb AS c0, syy - ca * say - cb * sby AS rss FROM c),
e AS (SELECT *, rss / (n - 3) AS s2, 1 - rss / syy AS r2 FROM r)"""


_OLS = _two_feature_sql("square_feet", "bedrooms", "price")
_IMPUTE = _two_feature_sql("accommodates", "price", "square_feet")


def _ols_row(term: str, est: str, var: str) -> str:
    return f"""SELECT '{term}' AS term, {fixed_sql(est, 5)} AS estimate,
  {fixed_sql(f'sqrt(s2 * ({var}))', 5)} AS std_error,
  {fixed_sql(f'{est} / sqrt(s2 * ({var}))', 6)} AS t, {fixed_sql('r2', 6)} AS r2 FROM e"""


_MOM = """stats AS (SELECT {g} AS g, count({v})::DOUBLE AS n, avg({v}) AS m,
    count({v}) * var_pop({v}) AS w FROM listings WHERE {v} IS NOT NULL GROUP BY 1)"""


def _mi_sql() -> str:
    cuts = "[" + ", ".join(repr(i / 10) for i in range(1, 10)) + "]"
    columns = [*SCORED, "price"]
    q = ", ".join(f"quantile_cont({c}::DOUBLE, {cuts}) AS q_{c}" for c in columns)
    binned = ", ".join(
        f"len(list_filter(q_{c}, lambda e: {c}::DOUBLE > e)) AS x_{c}" for c in columns
    )
    joint = "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, x_{c} AS x, x_price AS y, count(*)::DOUBLE AS nxy"
        f" FROM binned GROUP BY 2, 3"
        for c in SCORED
    )
    f_parts = "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, pow(corr({c}, price), 2) AS r2, count(*) AS n FROM listings"
        for c in SCORED
    )
    return f"""q AS (SELECT {q} FROM listings),
binned AS (SELECT {binned} FROM listings, q),
joint AS ({joint}),
marg AS (SELECT feature, nxy, sum(nxy) OVER (PARTITION BY feature, x) AS nx,
    sum(nxy) OVER (PARTITION BY feature, y) AS ny, sum(nxy) OVER (PARTITION BY feature) AS n
  FROM joint),
mi AS (SELECT feature, sum(nxy / n * ln(nxy * n / (nx * ny))) AS mi FROM marg GROUP BY 1),
fs AS (SELECT feature, r2 * (n - 2) / (1 - r2) AS f FROM ({f_parts})),
both_scores AS (SELECT fs.feature, f / max(f) OVER () AS f, mi / max(mi) OVER () AS mi
  FROM fs JOIN mi ON fs.feature = mi.feature)
SELECT feature, {fixed_sql('f', 6)} AS f, {fixed_sql('mi', 6)} AS mi, mi > 0.3 AS keep
FROM both_scores"""


SQL = {
    "anova": _MORE
    + _MOM.format(g="neighbourhood", v="price")
    + f""",
grand AS (SELECT sum(n * m) / sum(n) AS g FROM stats)
SELECT count(*) - 1 AS df_between, CAST(sum(n) AS BIGINT) - count(*) AS df_within,
  {fixed_sql('(sum(n * pow(m - grand.g, 2)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*)))', 6)}
  AS f FROM stats, grand""",
    "kruskal_wallis": _MORE
    + f"""ranked AS (SELECT neighbourhood,
    count(*) OVER (PARTITION BY square_feet)::DOUBLE AS t,
    rank() OVER (ORDER BY square_feet)
      + (count(*) OVER (PARTITION BY square_feet) - 1) / 2.0::DOUBLE AS r
  FROM listings WHERE square_feet IS NOT NULL),
per AS (SELECT neighbourhood, count(*)::DOUBLE AS n, sum(r) AS rs, sum(t * t - 1) AS tp
  FROM ranked GROUP BY 1),
tot AS (SELECT sum(n) AS big FROM per)
SELECT count(*) - 1 AS df, {fixed_sql('''(12.0::DOUBLE * sum(n * pow(rs / n - (big + 1) / 2, 2))
  / (max(big) * (max(big) + 1))) / (1 - sum(tp) / (pow(max(big), 3) - max(big)))''', 6)} AS h
FROM per, tot""",
    "tukey_pairs": _MORE.replace("WITH", "WITH RECURSIVE", 1)
    + _MOM.format(g="neighbourhood", v="square_feet")
    + _TUKEY.format(pairs="a.g < b.g")
    + f"SELECT group_a, group_b, {_JUDGED} FROM judged",
    "tukey_to_control": _MORE.replace("WITH", "WITH RECURSIVE", 1)
    + _MOM.format(g="neighbourhood", v="square_feet")
    + _TUKEY.format(pairs="a.g = 'Brand#1'")
    + f"SELECT group_a AS control, group_b AS neighbourhood, {_JUDGED} FROM judged",
    "group_similarity": _MORE.replace("WITH", "WITH RECURSIVE", 1)
    + _MOM.format(g="neighbourhood", v="square_feet")
    + _TUKEY.format(pairs="a.g < b.g")
    + f""", v AS (
  SELECT group_a, group_b, round(p, 4) AS value FROM judged
  UNION ALL SELECT group_b, group_a, round(p, 4) FROM judged
  UNION ALL SELECT g, g, 1 FROM stats)
SELECT group_a, group_b, {fixed_sql('value', 4)} AS value, {fixed_sql('1 - value', 4)} AS distance FROM v""",
    "normality": _MORE
    + f"""c AS (SELECT property_type, price - avg(price) OVER (PARTITION BY property_type) AS d
  FROM listings),
m AS (SELECT property_type, count(*) AS n, avg(d * d) AS m2, avg(d * d * d) AS m3,
    avg(d * d * d * d) AS m4 FROM c GROUP BY 1),
s AS (SELECT property_type, n, m3 / pow(m2, 1.5::DOUBLE) AS sk, m4 / (m2 * m2) - 3 AS ku FROM m),
j AS (SELECT *, n / 6.0::DOUBLE * (sk * sk + ku * ku / 4) AS jb FROM s)
SELECT property_type, n, {fixed_sql('sk', 6)} AS skewness, {fixed_sql('ku', 6)} AS kurtosis,
  {fixed_sql('jb', 3)} AS jb, {fixed_sql('exp(-jb / 2)', 6)} AS p FROM j""",
    "normality_fitted": _MORE
    + f"""r AS (SELECT property_type, price::DOUBLE AS v, row_number() OVER w AS i,
    count(*) OVER (PARTITION BY property_type) AS n, avg(price::DOUBLE) OVER (PARTITION BY property_type) AS m,
    stddev_samp(price::DOUBLE) OVER (PARTITION BY property_type) AS sd
  FROM listings WHERE price IS NOT NULL WINDOW w AS (PARTITION BY property_type ORDER BY price)),
z AS (SELECT property_type, i, n, (v - m) / nullif(sd, 0) AS z, abs((v - m) / nullif(sd, 0)) / sqrt(2::DOUBLE) AS x FROM r),
l AS (SELECT property_type, i, n, z, {_HALF} AS half FROM z),
a AS (SELECT property_type, n, -n - sum((2 * i - 1) * CASE WHEN z < 0 THEN half ELSE ln(1 - exp(half)) END
    + (2 * (n - i) + 1) * CASE WHEN z <= 0 THEN ln(1 - exp(half)) ELSE half END) / n AS a2
  FROM l GROUP BY property_type, n),
s AS (SELECT *, a2 * (1 + 0.75::DOUBLE / n + 2.25::DOUBLE / (n * n)) AS s FROM a)
SELECT property_type, n, {fixed_sql('a2', 6)} AS a2,
  {fixed_sql(f"CASE WHEN s IS NULL THEN NULL {_AD_P} ELSE {hypothesis.AD_LEAST!r}::DOUBLE END", 6)} AS p FROM s""",
    "proportion_ci": _L
    + """SELECT count(*) FILTER (bedrooms = 3) AS hits, count(*) AS n,
  round(count(*) FILTER (bedrooms = 3) * 100.0::DOUBLE / count(*), 2) AS percent FROM listings""",
    "ols_normal_eq": _MORE
    + _OLS
    + "\n"
    + _ols_row(
        "(intercept)", "c0", "1 / n + (ma * ma * sbb - 2 * ma * mb * sab + mb * mb * saa) / det"
    )
    + "\nUNION ALL "
    + _ols_row("square_feet", "ca", "sbb / det")
    + "\nUNION ALL "
    + _ols_row("bedrooms", "cb", "saa / det"),
    # With an even number of degrees between groups both tails are finite sums.
    "test_p_values": _MORE
    + _MOM.format(g="neighbourhood", v="price")
    + f""",
grand AS (SELECT sum(n * m) / sum(n) AS g FROM stats),
a AS (SELECT count(*) - 1 AS d1, sum(n) - count(*) AS d2,
    (sum(n * pow(m - grand.g, 2)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))) AS f FROM stats, grand),
ranked AS (SELECT neighbourhood,
    count(*) OVER (PARTITION BY square_feet)::DOUBLE AS t,
    rank() OVER (ORDER BY square_feet)
      + (count(*) OVER (PARTITION BY square_feet) - 1) / 2.0::DOUBLE AS r
  FROM listings WHERE square_feet IS NOT NULL),
per AS (SELECT neighbourhood, count(*)::DOUBLE AS n, sum(r) AS rs, sum(t * t - 1) AS tp
  FROM ranked GROUP BY 1),
tot AS (SELECT sum(n) AS big FROM per),
k AS (SELECT count(*) - 1 AS df, (12.0::DOUBLE * sum(n * pow(rs / n - (big + 1) / 2, 2))
  / (max(big) * (max(big) + 1))) / (1 - sum(tp) / (pow(max(big), 3) - max(big))) AS h FROM per, tot),
tails AS (
  SELECT 'anova' AS test, f AS s, list_sum(list_transform(range(0, CAST(d1 / 2 AS BIGINT)),
    lambda j: exp(d2 / 2 * ln(d2 / (d2 + d1 * f)) + lgamma(d2 / 2 + j) - lgamma(d2 / 2)
      - lgamma(j + 1.0::DOUBLE) + j * ln(d1 * f / (d2 + d1 * f))))) AS p FROM a
  UNION ALL SELECT 'kruskal_wallis', h, list_sum(list_transform(range(0, CAST(df / 2 AS BIGINT)),
    lambda j: exp(-h / 2 + j * ln(h / 2) - lgamma(j + 1.0::DOUBLE)))) FROM k)
SELECT test, {fixed_sql('s', 6)} AS statistic, {fixed_sql('p', 6)} AS p FROM tails""",
    "proportion_bounds": "WITH RECURSIVE "
    + LISTINGS
    + f""",
c AS (SELECT count(*) FILTER (bedrooms = 3) AS hits, count(*) AS n FROM listings),
bounds AS (  -- bisection: P(X >= hits) = 0.05 at the lower bound, P(X <= hits) = 0.05 at the upper
  SELECT 0 AS i, hits, n, 0.0::DOUBLE AS a0, 1.0::DOUBLE AS a1, 0.0::DOUBLE AS b0, 1.0::DOUBLE AS b1 FROM c
  UNION ALL
  SELECT i + 1, hits, n, CASE WHEN up < 0.05 THEN (a0 + a1) / 2 ELSE a0 END,
    CASE WHEN up < 0.05 THEN a1 ELSE (a0 + a1) / 2 END,
    CASE WHEN down > 0.05 THEN (b0 + b1) / 2 ELSE b0 END,
    CASE WHEN down > 0.05 THEN b1 ELSE (b0 + b1) / 2 END
  FROM (SELECT *,
      1 - list_sum(list_transform(range(0, hits), lambda k: exp(lgamma(n + 1.0::DOUBLE) - lgamma(k + 1.0::DOUBLE)
        - lgamma(n - k + 1.0::DOUBLE) + k * ln((a0 + a1) / 2) + (n - k) * ln(1 - (a0 + a1) / 2)))) AS up,
      list_sum(list_transform(range(0, hits + 1), lambda k: exp(lgamma(n + 1.0::DOUBLE) - lgamma(k + 1.0::DOUBLE)
        - lgamma(n - k + 1.0::DOUBLE) + k * ln((b0 + b1) / 2) + (n - k) * ln(1 - (b0 + b1) / 2)))) AS down
    FROM bounds WHERE i < 45))
SELECT hits, n, {fixed_sql('(a0 + a1) * 50', 6)} AS low, {fixed_sql('(b0 + b1) * 50', 6)} AS high
FROM bounds WHERE i = 45""",
    # The dummies are eliminated: slopes from the cross products within levels, levels from their means.
    "ols_summary": _MORE
    + f"""lv AS (SELECT room_type AS g, count(*)::DOUBLE AS n, avg(accommodates) AS a, avg(bedrooms) AS b,
    avg(price) AS y, count(*) * var_pop(accommodates) AS aa, count(*) * var_pop(bedrooms) AS bb,
    count(*) * var_pop(price) AS yy, count(*) * covar_pop(accommodates, bedrooms) AS ab,
    count(*) * covar_pop(accommodates, price) AS ay, count(*) * covar_pop(bedrooms, price) AS byy
  FROM listings GROUP BY 1),
s AS (SELECT sum(n) AS n, count(*) AS k, sum(aa) AS aa, sum(bb) AS bb, sum(yy) AS yy, sum(ab) AS ab,
    sum(ay) AS ay, sum(byy) AS byy, sum(n * y) / sum(n) AS ym, sum(aa) * sum(bb) - sum(ab) * sum(ab) AS det FROM lv),
e AS (SELECT *, (bb * ay - ab * byy) / det AS ca, (aa * byy - ab * ay) / det AS cb, n - k - 2 AS dof FROM s),
q AS (SELECT e.*, (yy - ca * ay - cb * byy) / dof AS s2,
    1 - (yy - ca * ay - cb * byy) / (yy + (SELECT sum(lv.n * pow(lv.y - s.ym, 2)) FROM lv, s)) AS r2 FROM e),
r AS (SELECT * FROM lv ORDER BY g LIMIT 1),
terms AS (
  SELECT '(intercept)' AS term, r.y - q.ca * r.a - q.cb * r.b AS est,
    q.s2 * (1 / r.n + (r.a * r.a * q.bb - 2 * r.a * r.b * q.ab + r.b * r.b * q.aa) / q.det) AS var FROM q, r
  UNION ALL SELECT 'accommodates', ca, s2 * bb / det FROM q
  UNION ALL SELECT 'bedrooms', cb, s2 * aa / det FROM q
  UNION ALL SELECT 'room_type=' || lv.g, lv.y - r.y - q.ca * (lv.a - r.a) - q.cb * (lv.b - r.b),
    q.s2 * (1 / lv.n + 1 / r.n + (pow(lv.a - r.a, 2) * q.bb - 2 * (lv.a - r.a) * (lv.b - r.b) * q.ab
      + pow(lv.b - r.b, 2) * q.aa) / q.det)
  FROM lv, r, q WHERE lv.g <> r.g),
t AS (SELECT term, est, sqrt(var) AS se, est / sqrt(var) AS t, dof, r2,
    least(abs(est / sqrt(var)), 12) / 1200 AS h FROM terms, q),
-- Simpson's rule on the density up to |t|; the quantile from its expansion in 1 / degrees
p AS (SELECT *, greatest(0, 1 - 2 * h / 3 * list_sum(list_transform(range(0, 1201), lambda i:
      (CASE WHEN i IN (0, 1200) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
      * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - (dof + 1) / 2 * ln(1 + i * h * i * h / dof))
      / sqrt(dof * pi())))) AS p,
    1.959963984540054::DOUBLE + (pow(1.959963984540054::DOUBLE, 3) + 1.959963984540054::DOUBLE) / (4 * dof)
      AS z FROM t)
SELECT term, {fixed_sql('est', 4)} AS estimate, {fixed_sql('se', 4)} AS std_error, {fixed_sql('t', 4)} AS t,
  {fixed_sql('p', 4)} AS p, {fixed_sql('est - z * se', 4)} AS low, {fixed_sql('est + z * se', 4)} AS high,
  {fixed_sql('r2', 4)} AS r2 FROM p""",
    "residual_table": with_ctes(_HOUSES)
    + f"""SELECT id, sale_price, {fixed_sql('f', 6)} AS fitted, {fixed_sql('sale_price - f', 6)} AS residual
FROM (SELECT h.*, c0 + c1 * living_area AS f FROM houses h,
  (SELECT regr_slope(sale_price, living_area) AS c1, regr_intercept(sale_price, living_area) AS c0
   FROM houses))""",
    "fitted_line": with_ctes(_HOUSES)
    + f"""SELECT CAST(i AS INTEGER) AS i, {fixed_sql('x', 6)} AS year_built,
  {fixed_sql('c0 + c1 * x', 6)} AS fitted
FROM (SELECT i, lo + i * (hi - lo) / 999 AS x, c0, c1 FROM generate_series(0, 999) t(i),
  (SELECT min(year_built) AS lo, max(year_built) AS hi, regr_slope(sale_price, year_built) AS c1,
     regr_intercept(sale_price, year_built) AS c0 FROM houses))""",
    "fit_errors": _MORE
    + f"""c AS (SELECT regr_slope(price, accommodates) AS c1, regr_intercept(price, accommodates) AS c0
  FROM listings)
SELECT room_type, {fixed_sql('sqrt(avg(pow(price - c0 - c1 * accommodates, 2)))', 4)} AS rmse,
  {fixed_sql('1 - avg(pow(price - c0 - c1 * accommodates, 2)) / var_pop(price)', 6)} AS r2
FROM listings, c GROUP BY 1""",
    "gradient_descent": "WITH RECURSIVE "
    + _HOUSES
    + f""",
m AS (SELECT count(*)::DOUBLE AS n, avg(sale_price) AS my,
    covar_pop(sale_price, living_area) * count(*) / stddev_samp(living_area) AS xy,
    var_pop(sale_price) * count(*) + count(*) * avg(sale_price) * avg(sale_price) AS yy FROM houses),
steps AS (SELECT 0 AS iteration, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1
  UNION ALL SELECT iteration + 1, w0 - 0.5::DOUBLE / n * (n * w0 - n * my),
    w1 - 0.5::DOUBLE / n * ((n - 1) * w1 - xy) FROM steps, m WHERE iteration < 2000)
SELECT iteration, {fixed_sql('w0', 5)} AS w0, {fixed_sql('w1', 5)} AS w1,
  {fixed_sql('0.5::DOUBLE * (yy - 2 * (w0 * n * my + w1 * xy) + n * w0 * w0 + (n - 1) * w1 * w1)', 1)}
    AS loss FROM steps, m""",
    "mean_mode_impute": _TRAIN
    + f"""
SELECT id, {fixed_sql('coalesce(square_feet, (SELECT avg(square_feet) FROM train))', 6)}
    AS square_feet,
  coalesce(property_type, (SELECT property_type FROM train WHERE property_type IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS property_type FROM holes""",
    "target_encode": _TRAIN
    + f""",
enc AS (SELECT property_type, avg(price_cents) AS e FROM train
  WHERE property_type IS NOT NULL GROUP BY 1)
SELECT id, h.property_type,
  {fixed_sql('coalesce(e, (SELECT avg(price_cents) FROM train))', 4)} AS encoded
FROM holes h LEFT JOIN enc ON h.property_type = enc.property_type""",
    "standardised": _TRAIN
    + f""",
s AS (SELECT avg(accommodates) AS ma, stddev_pop(accommodates) AS sa, avg(bedrooms) AS mb,
  stddev_pop(bedrooms) AS sb FROM train)
SELECT id, {fixed_sql('(accommodates - ma) / sa', 6)} AS accommodates_z,
  {fixed_sql('(bedrooms - mb) / sb', 6)} AS bedrooms_z FROM holes, s""",
    "interaction_features": _L
    + f"""SELECT id, bedrooms * bedrooms AS bedrooms_squared, bedrooms * accommodates AS bed_bath_rooms,
  {fixed_sql('score * extra_people', 6)} AS lat_times_lon FROM listings""",
    "feature_scores": _MORE + _mi_sql(),
    "model_impute": _MORE
    + _IMPUTE
    + f"""
SELECT id, {fixed_sql('coalesce(square_feet, c0 + ca * accommodates + cb * price)', 4)} AS square_feet
FROM listings, e""",
}
