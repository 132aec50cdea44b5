"""Listing queries: cleaning, group statistics, histograms, splits."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.columns import fixed, parse_day, square_metres, unit_number, year_offset
from tabularium.operators import cleaning, groups, similarity, splits
from tabularium.plans.common import FEATURES, LISTINGS, POSTAL_CODES, fixed_sql, with_ctes
from tabularium.session import new_folder
from tabularium.sources import shapes, text

_L = with_ctes(LISTINGS)
NUMERIC = ["price", "bedrooms", "accommodates", "square_feet"]


def listing_clean(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.listings(spark, sf)
    df = cleaning.all_equal(df, {"room_type": "A"})
    df = cleaning.non_empty(df, "neighbourhood")
    df = df.withColumn("square_metres", square_metres("square_feet"))
    size = F.col("square_metres")
    df = cleaning.nullify(df, {"square_metres": (size == 0) | (size > 150) | (size < 20)})
    df = cleaning.recode(df, "bedrooms", {7: 6})
    df = df.drop("square_feet", "score", "extra_people").withColumn("origin", F.lit("listing"))
    return df.select(
        "id", "neighbourhood", "room_type", "price", "bedrooms", "square_metres", "origin"
    ).withColumnsRenamed({"price": "rate"})


def code_repair(spark: SparkSession, sf: str) -> DataFrame:
    codes = shapes.postal_codes(spark, sf)
    corrections = codes.filter(F.col("code") == "Madrid 28004").select(
        "id", F.lit("28004").alias("code")
    )
    return cleaning.repair_codes(codes, "code", corrections).select("id", "code")


def range_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    cutoffs = [("price", 5000.0, 60000.0), ("accommodates", 2.0, 40.0), ("bedrooms", 1, 6)]
    kept = cleaning.range_cutoffs(shapes.listings(spark, sf), cutoffs)
    return kept.select("id", "price_cents", "accommodates", "bedrooms")


def membership_filter(spark: SparkSession, sf: str) -> DataFrame:
    five = ["Brand#1", "Brand#4", "Brand#7", "Brand#15", "Brand#20"]
    kept = cleaning.members(shapes.listings(spark, sf), "neighbourhood", five)
    return kept.select("id", "neighbourhood", "room_type")


def column_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.listings(spark, sf).select(
        "id", F.col("bedrooms").cast("double").alias("bedrooms"), "accommodates"
    )
    return cleaning.differing(df, "bedrooms", "accommodates")


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.null_profile(shapes.listings(spark, sf), ["square_feet", "price", "score"])
    return df.withColumns(
        {"null_percent": fixed("null_percent", 6), "zero_percent": fixed("zero_percent", 6)}
    )


def describe_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.describe(shapes.listings(spark, sf), NUMERIC)
    return df.withColumns(
        {c: fixed(c, 4) for c in ["mean", "sd", "min", "max", "q1", "median", "q3"]}
    )


def shape_profile(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.shape_profile(shapes.listings(spark, sf))


def drop_allnull_groups(spark: SparkSession, sf: str) -> DataFrame:
    kept = groups.drop_allnull_groups(
        shapes.listings(spark, sf), "neighbourhood", "square_feet"
    )
    return kept.select("id", "neighbourhood", "square_feet")


def drop_rare_groups(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.listings(spark, sf).withColumn(
        "spot", F.concat_ws("/", "neighbourhood", "property_type", "bedrooms")
    )
    return groups.drop_rare_groups(df, "spot", 60).select("id", "spot")


def group_counts_column(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.with_group_count(shapes.listings(spark, sf), "property_type")
    return df.select("id", "property_type", "group_n")


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return groups.value_counts(shapes.listings(spark, sf), "square_feet")


def group_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.listings(spark, sf)
    counts = groups.value_counts(df, "neighbourhood")
    means = groups.group_means(df, "neighbourhood", "price_cents")
    return groups.merge_on_group(counts, means, "neighbourhood").withColumn(
        "mean", fixed("mean", 4)
    )


def _ranked(spark: SparkSession, sf: str, lowest: bool) -> DataFrame:
    stats = groups.count_and_mean(shapes.listings(spark, sf), "neighbourhood", "price_cents")
    return groups.top_groups(stats, "mean", "neighbourhood", 5, lowest).withColumn(
        "mean", fixed("mean", 4)
    )


def top5_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, lowest=False)


def bottom5_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf, lowest=True)


def top5_dense_groups(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.top_dense_groups(
        shapes.listings(spark, sf), "neighbourhood", "price_cents", min_rows=100
    )
    return df.withColumn("mean", fixed("mean", 4))


def distinct_groups(spark: SparkSession, sf: str) -> DataFrame:
    return groups.distinct_values(shapes.listings(spark, sf), "neighbourhood")


def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return groups.distinct_count(
        shapes.listings(spark, sf), ["neighbourhood", "property_type", "price_cents"]
    )


def group_mode(spark: SparkSession, sf: str) -> DataFrame:
    return groups.modes(shapes.listings(spark, sf), ["neighbourhood"], "square_feet")


def group_mode_fill(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.fill_group_mode(shapes.listings(spark, sf), "neighbourhood", "square_feet")
    return df.select("id", "neighbourhood", "square_feet")


def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.correlation_matrix(
        shapes.listings(spark, sf), ["price", "bedrooms", "accommodates", "score"]
    )
    return df.withColumn("r", fixed("r", 6))


def corr_pairwise(spark: SparkSession, sf: str) -> DataFrame:
    """Correlations with a column that has NULLs: each pair uses the rows where both are known."""
    df = groups.correlation_matrix(
        shapes.listings(spark, sf), ["price", "bedrooms", "square_feet"], pairwise=True
    )
    return df.withColumn("r", fixed("r", 6))


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The two listing splits written as semicolon CSV, read back with a schema, summed up."""
    root = new_folder(spark, "csv")
    df = shapes.listings(spark, sf).select(
        "id", "neighbourhood", "room_type", "price_cents", "square_feet"
    )
    train, test = splits.sample_and_rest(df, "id", 80, "csv")
    schema = train.schema
    back = []
    for name, part in (("train", train), ("test", test)):
        text.write_csv(part, f"{root}/{name}")
        back.append(
            text.read_csv(spark, f"{root}/{name}", schema=schema).withColumn("part", F.lit(name))
        )
    return (
        back[0]
        .unionByName(back[1])
        .groupBy("part", "room_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("square_feet").alias("with_size"),
            F.sum("price_cents").alias("cents"),
        )
    )


def histogram_bins(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.histogram(shapes.listings(spark, sf), "price_cents", 20)
    return df.withColumns({"bin_lo": fixed("bin_lo", 3), "bin_hi": fixed("bin_hi", 3)})


def break_points(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.break_points(shapes.listings(spark, sf), "price_cents", 10)
    return df.withColumn("at", fixed("at", 3))


def density_grid(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.density_grid(shapes.listings(spark, sf), "room_type", "price", 64)
    return df.withColumns({"at": fixed("at", 4), "density": fixed("density", 10)})


def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.box_stats(shapes.listings(spark, sf), "neighbourhood", "price")
    return df.withColumns(
        {c: fixed(c, 4) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]}
    )


def qq_table(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.quantile_table(shapes.listings(spark, sf), "room_type", "price", 99)
    return df.withColumns({c: fixed(c, 4) for c in ["theoretical", "sample", "line"]})


def listing_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Day texts parsed, years as an offset, unreadable days filled with the neighbourhood's mode."""
    written = F.when(F.col("bedrooms") == 6, F.lit("n/a")).otherwise(F.date_format("listed_on", "yyyy-MM-dd"))
    df = shapes.listings(spark, sf).select("neighbourhood", parse_day(written).alias("day"))
    df = df.select("neighbourhood", year_offset("day", 1990).alias("years"), F.col("day").isNull().alias("filled"))
    out = groups.fill_group_mode(df, "neighbourhood", "years")
    return out.groupBy("neighbourhood", "years", "filled").agg(F.count(F.lit(1)).alias("n"))


def feature_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbourhood features written as JSON lines (one feature each) and read back."""
    path = new_folder(spark, "features")
    text.write_feature_lines(shapes.features(spark, sf), path)
    total = F.aggregate("avgbedrooms", F.lit(0).cast("long"), lambda acc, b: acc + b["total"])
    return text.read_feature_lines(spark, path).select(
        "name", "avgprice", F.size("avgbedrooms").alias("sizes"), total.alias("listings")
    )


def feature_rollup(spark: SparkSession, sf: str) -> DataFrame:
    df = groups.price_colours(groups.feature_rollup(shapes.features(spark, sf)))
    return df.drop("avgbedrooms").withColumns(
        {"mean_bedrooms": fixed("mean_bedrooms", 6), "position": fixed("position", 6)}
    )


def feature_bars(spark: SparkSession, sf: str) -> DataFrame:
    return groups.bar_colours(groups.feature_rollup(shapes.features(spark, sf)))


def keyed_dot(spark: SparkSession, sf: str) -> DataFrame:
    amounts = shapes.quantities(spark, sf).withColumn("quantity", unit_number("quantity"))
    df = similarity.keyed_dot(
        amounts, shapes.costs(spark, sf), "item", "quantity", "cost", by=["basket"]
    )
    return df.withColumn("dot", fixed("dot", 2))


def fixed_group_sample(spark: SparkSession, sf: str) -> DataFrame:
    df = splits.fixed_group_sample(shapes.listings(spark, sf), "room_type", "id", 4999)
    return df.select("id", "room_type")


def sample_complement(spark: SparkSession, sf: str) -> DataFrame:
    sample, rest = splits.sample_and_rest(shapes.listings(spark, sf), "id", 70)
    tagged = sample.withColumn("part", F.lit("sample")).unionByName(
        rest.withColumn("part", F.lit("rest"))
    )
    return tagged.select("id", "part")


QUERIES = {
    f.__name__: f
    for f in (
        listing_clean,
        code_repair,
        range_cutoffs,
        membership_filter,
        column_mismatch,
        null_profile,
        describe_profile,
        shape_profile,
        drop_allnull_groups,
        drop_rare_groups,
        group_counts_column,
        value_counts,
        group_summary,
        top5_groups,
        bottom5_groups,
        top5_dense_groups,
        distinct_groups,
        distinct_counts,
        group_mode,
        group_mode_fill,
        corr_matrix,
        corr_pairwise,
        csv_round_trip,
        histogram_bins,
        break_points,
        density_grid,
        box_stats,
        qq_table,
        listing_dates,
        feature_lines,
        feature_rollup,
        feature_bars,
        keyed_dot,
        fixed_group_sample,
        sample_complement,
    )
}


def _describe_one(c: str) -> str:
    f = fixed_sql
    return f"""SELECT '{c}' AS "column", count({c}) AS count, {f(f'avg({c})', 4)} AS mean,
  {f(f'stddev_samp({c})', 4)} AS sd, {f(f'min({c})', 4)} AS min, {f(f'max({c})', 4)} AS max,
  {f(f'quantile_cont({c}::DOUBLE, 0.25)', 4)} AS q1,
  {f(f'quantile_cont({c}::DOUBLE, 0.5)', 4)} AS median,
  {f(f'quantile_cont({c}::DOUBLE, 0.75)', 4)} AS q3 FROM listings"""


def _profile_one(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls,
  {fixed_sql(f'(count(*) - count({c})) * 100.0::DOUBLE / count(*)', 6)} AS null_percent,
  {fixed_sql(f'count(CASE WHEN {c} = 0 THEN 1 END) * 100.0::DOUBLE / count({c})', 6)}
    AS zero_percent FROM listings"""


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


# Column types as the engine names them.
_SHAPE = [
    ("id", "string"),
    ("neighbourhood", "string"),
    ("room_type", "string"),
    ("property_type", "string"),
    ("price", "double"),
    ("price_cents", "bigint"),
    ("bedrooms", "int"),
    ("accommodates", "double"),
    ("extra_people", "double"),
    ("score", "double"),
    ("listed_on", "timestamp_ntz"),
    ("square_feet", "double"),
]

_CORR = ["price", "bedrooms", "accommodates", "score"]
_RANKED = """stats AS (SELECT neighbourhood, count(*) AS n, avg(price_cents) AS m
  FROM listings GROUP BY 1)
SELECT neighbourhood, n, {mean} AS mean FROM stats {where} ORDER BY m {order}, neighbourhood LIMIT 5"""


def _ranked_sql(order: str, where: str = "") -> str:
    return (
        _L.rstrip() + ",\n" + _RANKED.format(mean=fixed_sql("m", 4), order=order, where=where)
    )


_NORMAL = NormalDist()
_QQ_SHARES = [(i + 0.5) / 99 for i in range(99)]
_QQ_THEORY = "[" + ", ".join(repr(_NORMAL.inv_cdf(s)) + "::DOUBLE" for s in _QQ_SHARES) + "]"
_QQ_LIST = "[" + ", ".join(repr(s) for s in _QQ_SHARES) + "]"
_Z1, _Z3 = _NORMAL.inv_cdf(0.25), _NORMAL.inv_cdf(0.75)

_MODE = """counted AS (SELECT neighbourhood, square_feet, count(*) AS n FROM listings
  WHERE square_feet IS NOT NULL GROUP BY 1, 2),
modes AS (SELECT neighbourhood, square_feet AS mode FROM counted
  QUALIFY row_number() OVER (PARTITION BY neighbourhood ORDER BY n DESC, square_feet) = 1)"""

_BUCKET = "CAST(('0x' || substr(md5({salt}{key}), 1, 8)) AS BIGINT) % 100"

SQL = {
    "listing_dates": _L.rstrip()
    + """,
d AS (SELECT neighbourhood, CASE WHEN bedrooms <> 6 THEN CAST(year(listed_on) - 1990 AS INTEGER) END AS years
  FROM listings),
c AS (SELECT neighbourhood, years, count(*) AS n FROM d WHERE years IS NOT NULL GROUP BY ALL),
m AS (SELECT neighbourhood, arg_min(years, [-n, years]) AS mode FROM c GROUP BY 1)
SELECT d.neighbourhood, coalesce(years, mode) AS years, years IS NULL AS filled, count(*) AS n
FROM d LEFT JOIN m ON d.neighbourhood = m.neighbourhood GROUP BY ALL""",
    "feature_lines": """WITH p AS (SELECT p_brand AS name, CAST(p_size % 6 AS INTEGER) AS bedrooms,
    CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part)
SELECT name, CASE WHEN name NOT IN ('Brand#3', 'Brand#11')
    THEN floor(sum(cents) / 100.0::DOUBLE / count(*) * 100 + 0.5::DOUBLE)::DOUBLE END AS avgprice,
  CAST(count(DISTINCT bedrooms) AS INTEGER) AS sizes, count(*) AS listings FROM p GROUP BY 1""",
    "listing_clean": _L
    + """, measured AS (SELECT *, round(square_feet * 0.092903::DOUBLE, 2) AS m2 FROM listings
  WHERE room_type = 'A' AND neighbourhood <> '')
SELECT id, neighbourhood, room_type, price AS rate,
  CASE WHEN bedrooms = 7 THEN 6 ELSE bedrooms END AS bedrooms,
  CASE WHEN m2 = 0 OR m2 > 150 OR m2 < 20 THEN NULL ELSE m2 END AS square_metres,
  'listing' AS origin FROM measured""".lstrip(),
    "code_repair": with_ctes(POSTAL_CODES)
    + """, firsts AS (SELECT id, code, trim(split_part(code, chr(10), 1)) AS f FROM postal)
SELECT id, CASE WHEN code = 'Madrid 28004' THEN '28004'
  WHEN f IN ('', '-', '28') OR f NOT LIKE '28%' THEN NULL
  WHEN f = '2804' THEN '28004' WHEN f = '2805' THEN '28005' WHEN f = '2815' THEN '28015'
  ELSE f END AS code FROM firsts""",
    "range_cutoffs": _L
    + """SELECT id, price_cents, accommodates, bedrooms FROM listings
WHERE price > 5000 AND price < 60000 AND accommodates > 2 AND accommodates < 40
  AND bedrooms > 1 AND bedrooms < 6""",
    "membership_filter": _L
    + """SELECT id, neighbourhood, room_type FROM listings
WHERE neighbourhood IN ('Brand#1', 'Brand#4', 'Brand#7', 'Brand#15', 'Brand#20')""",
    "column_mismatch": _L
    + """SELECT id, bedrooms::DOUBLE AS bedrooms, accommodates FROM listings
WHERE bedrooms::DOUBLE <> accommodates""",
    "null_profile": _L + _union(_profile_one(c) for c in ["square_feet", "price", "score"]),
    "describe_profile": _L + _union(_describe_one(c) for c in NUMERIC),
    "shape_profile": _L
    + _union(
        f"""SELECT {i}::INTEGER AS position, '{c}' AS "column", '{t}' AS type, count(*) AS rows,
  count({c}) AS non_null FROM listings"""
        for i, (c, t) in enumerate(_SHAPE)
    ),
    "drop_allnull_groups": _L
    + """SELECT id, neighbourhood, square_feet FROM listings WHERE neighbourhood IN
  (SELECT neighbourhood FROM listings GROUP BY 1 HAVING count(square_feet) > 0)""",
    "drop_rare_groups": _L.rstrip()
    + """, spots AS (SELECT id, concat_ws('/', neighbourhood, property_type, bedrooms) AS spot
  FROM listings)
SELECT id, spot FROM spots WHERE spot IN (SELECT spot FROM spots GROUP BY 1 HAVING count(*) >= 60)""",
    "group_counts_column": _L
    + "SELECT id, property_type, count(*) OVER (PARTITION BY property_type) AS group_n FROM listings",
    "value_counts": _L + "SELECT square_feet, count(*) AS n FROM listings GROUP BY 1",
    "group_summary": _L
    + f"""SELECT neighbourhood, count(*) AS n, {fixed_sql('avg(price_cents)', 4)} AS mean
FROM listings GROUP BY 1""",
    "top5_groups": _ranked_sql("DESC"),
    "bottom5_groups": _ranked_sql("ASC"),
    "top5_dense_groups": _ranked_sql("DESC", "WHERE n > 100"),
    "distinct_groups": _L + "SELECT DISTINCT neighbourhood FROM listings",
    "distinct_counts": _L
    + """SELECT count(DISTINCT neighbourhood) AS neighbourhood,
  count(DISTINCT property_type) AS property_type, count(DISTINCT price_cents) AS price_cents
FROM listings""",
    "group_mode": _L.rstrip() + ",\n" + _MODE + "\nSELECT neighbourhood, mode FROM modes",
    "group_mode_fill": _L.rstrip()
    + ",\n"
    + _MODE
    + """
SELECT l.id, l.neighbourhood, coalesce(l.square_feet, m.mode) AS square_feet
FROM listings l LEFT JOIN modes m ON l.neighbourhood = m.neighbourhood""",
    "corr_matrix": _L
    + _union(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        + (fixed_sql(f"corr({a}, {b})", 6) if a != b else "1.0::DOUBLE")
        + " AS r"
        + (" FROM listings" if a != b else "")
        for a in _CORR
        for b in _CORR
    ),
    "corr_pairwise": _L
    + _union(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        + (fixed_sql(f"corr({a}, {b})", 6) if a != b else "1.0::DOUBLE")
        + " AS r"
        + (" FROM listings" if a != b else "")
        for a in ["price", "bedrooms", "square_feet"]
        for b in ["price", "bedrooms", "square_feet"]
    ),
    "csv_round_trip": _L
    + f"""SELECT CASE WHEN {_BUCKET.format(salt="'csv' || ", key='id')} < 80 THEN 'train'
  ELSE 'test' END AS part, room_type, count(*) AS n, count(square_feet) AS with_size,
  CAST(sum(price_cents) AS BIGINT) AS cents FROM listings GROUP BY ALL""",
    "histogram_bins": _L.rstrip()
    + f""", lim AS (SELECT min(price_cents) AS low, max(price_cents) AS high,
    (max(price_cents) - min(price_cents)) / 20.0::DOUBLE AS w FROM listings),
placed AS (SELECT least(CAST(floor((price_cents - low) / w) AS INTEGER), 19) AS bin, count(*) AS n
  FROM listings, lim GROUP BY 1)
SELECT CAST(b AS INTEGER) AS bin, {fixed_sql('low + b * w', 3)} AS bin_lo,
  {fixed_sql('low + (b + 1) * w', 3)} AS bin_hi, coalesce(n, 0) AS n
FROM lim, generate_series(0, 19) t(b) LEFT JOIN placed ON bin = b""",
    "break_points": _L.rstrip()
    + f""", lim AS (SELECT min(price_cents) AS low, max(price_cents) AS high FROM listings)
SELECT CAST(i AS INTEGER) AS i, {fixed_sql('low + i * (high - low) / 10.0::DOUBLE', 3)} AS at
FROM lim, generate_series(0, 10) t(i)""",
    "density_grid": _L.rstrip()
    + f""", q AS (SELECT room_type, count(price) AS n, min(price) AS low, max(price) AS high,
    0.9::DOUBLE * coalesce(nullif(least(stddev_samp(price),
        (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)) / 1.34::DOUBLE), 0),
      nullif(stddev_samp(price), 0), nullif(abs(min(price)), 0), 1)
      * pow(count(price)::DOUBLE, -0.2::DOUBLE) AS bw FROM listings GROUP BY 1),
scale AS (SELECT room_type, n, bw, low - 3.0::DOUBLE * bw AS start,
    (high - low + 6.0::DOUBLE * bw) / 63 AS step FROM q),
pos AS (SELECT l.room_type, (l.price - start) / step AS p FROM listings l
  JOIN scale s ON l.room_type = s.room_type),
weights AS (SELECT room_type, j, sum(w) AS w FROM (
    SELECT room_type, floor(p) AS j, 1 - (p - floor(p)) AS w FROM pos
    UNION ALL SELECT room_type, floor(p) + 1, p - floor(p) FROM pos) GROUP BY 1, 2),
grid AS (SELECT s.*, i FROM scale s, generate_series(0, 63) t(i)),
dens AS (SELECT g.room_type, g.i, g.start + g.i * g.step AS spot,
    sum(w.w * exp(-0.5::DOUBLE * pow((g.i - w.j) * g.step / g.bw, 2)))
      / (g.n * g.bw * 2.5066282746310002::DOUBLE) AS density
  FROM grid g JOIN weights w ON g.room_type = w.room_type
  GROUP BY g.room_type, g.i, g.start, g.step, g.n, g.bw)
SELECT room_type, CAST(i AS INTEGER) AS i, {fixed_sql('spot', 4)} AS at,
  {fixed_sql('density', 10)} AS density FROM dens""",
    "box_stats": _L.rstrip()
    + f""", q AS (SELECT neighbourhood, quantile_cont(price, 0.25) AS q1,
    quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3
  FROM listings GROUP BY 1),
marked AS (SELECT q.*, price, price BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE
    AND q3 + (q3 - q1) * 1.5::DOUBLE AS inside
  FROM listings l JOIN q ON l.neighbourhood = q.neighbourhood)
SELECT neighbourhood, {fixed_sql('q1', 4)} AS q1, {fixed_sql('median', 4)} AS median,
  {fixed_sql('q3', 4)} AS q3, {fixed_sql('min(price) FILTER (inside)', 4)} AS whisker_lo,
  {fixed_sql('max(price) FILTER (inside)', 4)} AS whisker_hi,
  count(*) FILTER (NOT inside) AS outliers
FROM marked GROUP BY neighbourhood, q1, median, q3""",
    "qq_table": _L.rstrip()
    + f""", q AS (SELECT room_type, quantile_cont(price, 0.25) AS q1,
    quantile_cont(price, 0.75) AS q3, quantile_cont(price, {_QQ_LIST}) AS s
  FROM listings GROUP BY 1),
lined AS (SELECT *, (q3 - q1) / {_Z3 - _Z1!r}::DOUBLE AS slope FROM q),
rows AS (SELECT room_type, i, {_QQ_THEORY}[i] AS z, s[i] AS v, slope,
    q1 - slope * {_Z1!r}::DOUBLE AS intercept FROM lined, generate_series(1, 99) t(i))
SELECT room_type, CAST(i AS INTEGER) AS i, {fixed_sql('z', 4)} AS theoretical,
  {fixed_sql('v', 4)} AS sample, {fixed_sql('intercept + slope * z', 4)} AS line FROM rows""",
    "feature_rollup": with_ctes(FEATURES)
    + f""", totals AS (SELECT name, max(total) AS most, min(total) AS least,
    CAST(sum(total) AS BIGINT) AS flats, CAST(sum(total * bedrooms) AS BIGINT) AS rooms
  FROM sizes GROUP BY 1),
lim AS (SELECT min(avgprice) AS low, max(avgprice) AS high FROM priced)
SELECT t.*, p.avgprice, {fixed_sql('rooms::DOUBLE / flats', 6)} AS mean_bedrooms,
  {fixed_sql('(avgprice - low) / (high - low)', 6)} AS position,
  CASE WHEN avgprice IS NULL THEN 'red' ELSE 'scale' END AS fill,
  coalesce(CAST(CAST(avgprice AS BIGINT) AS VARCHAR) || ' Eur', 'Sin datos') AS caption
FROM totals t JOIN priced p ON t.name = p.name, lim""",
    "feature_bars": with_ctes(FEATURES)
    + """SELECT name, CAST(bedrooms AS INTEGER) AS bedrooms, total,
  CASE WHEN total = max(total) OVER (PARTITION BY name) THEN 'red'
       WHEN total = min(total) OVER (PARTITION BY name) THEN 'blue' ELSE '#93CAAE' END AS colour
FROM sizes""",
    "keyed_dot": f"""SELECT l_suppkey AS basket,
  {fixed_sql('sum(CAST(l_quantity AS INTEGER) * p_retailprice)', 2)} AS dot
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "fixed_group_sample": _L
    + """SELECT id, room_type FROM listings
QUALIFY row_number() OVER (PARTITION BY room_type ORDER BY md5(id), id) <= 4999""",
    "sample_complement": _L
    + f"""SELECT id, CASE WHEN {_BUCKET.format(salt='', key='id')} < 70 THEN 'sample'
  ELSE 'rest' END AS part FROM listings""",
}
# The fragments above continue the WITH list with a comma where they add their own expressions.
SQL = {k: v.replace(")\n, ", "),\n") for k, v in SQL.items()}
