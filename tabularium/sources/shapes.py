"""The input tables in the shapes the operators expect (devices, users, listings, comments, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a table as a file stream; the table is one file or a folder of parts.

    Spark takes a plain stream path for a folder, so the path is written as a pattern, which may match either.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parque[t]"
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(path)


def devices_from(events: DataFrame) -> DataFrame:
    """Event rows (batch or stream) as parsed device messages."""
    return events.select(
        F.round(F.col("value") * 100).cast("long").alias("bytes"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_type").alias("app"),
        F.col("user_id").cast("string").alias("id"),
        F.concat(
            F.lit("antenna_"),
            (F.get_json_object("props", "$.k").cast("long") % 10).cast("string"),
        ).alias("antenna_id"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices_from(table(spark, sf_dir, "events"))


def device_messages_from(events: DataFrame) -> DataFrame:
    """The same rows as raw broker messages: one JSON document in a binary ``value``."""
    d = devices_from(events)
    return d.select(
        F.to_json(
            F.struct(
                "bytes",
                F.unix_timestamp("timestamp").alias("timestamp"),
                "app",
                "id",
                "antenna_id",
            )
        )
        .cast("binary")
        .alias("value")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.floor(F.greatest("c_acctbal", F.lit(100.0))).cast("long").alias("quota"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rental listings; two neighbourhoods never report a size, some report zero."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    silent = F.col("p_brand").isin("Brand#7", "Brand#13")
    feet = F.when(
        ~silent & (F.col("l_partkey") % 16 == 0),
        F.when(F.col("l_partkey") % 160 == 0, F.lit(0.0)).otherwise(F.col("p_size") * F.lit(40.0)),
    )
    return line.join(part, line.l_partkey == part.p_partkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents).alias("id"),
        F.col("p_brand").alias("neighbourhood"),
        F.col("l_returnflag").alias("room_type"),
        F.col("p_type").alias("property_type"),
        F.col("l_extendedprice").alias("price"),
        cents.alias("price_cents"),
        F.col("l_linenumber").alias("bedrooms"),
        F.col("l_quantity").alias("accommodates"),
        F.col("l_tax").alias("extra_people"),
        F.col("l_discount").alias("score"),
        F.col("l_shipdate").alias("listed_on"),
        feet.alias("square_feet"),
    )


def postal_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a postal code column that carries typical entry errors."""
    k = F.col("c_custkey")
    good = F.concat(F.lit("28"), F.lpad((k % 1000).cast("string"), 3, "0"))
    slot = k % 50
    code = (
        F.when(slot == 0, F.lit(""))
        .when(slot == 1, F.lit("-"))
        .when(slot == 2, F.lit("28"))
        .when(slot == 3, F.lit("27004"))
        .when(slot == 4, F.lit("Madrid 28004"))
        .when(slot == 5, F.lit("28002\n28002"))
        .when(slot == 6, F.lit("2804"))
        .when(slot == 7, F.lit("2805"))
        .when(slot == 8, F.lit("2815"))
        .otherwise(good)
    )
    return table(spark, sf_dir, "customer").select(
        k.alias("id"), code.alias("code"), F.col("c_acctbal").alias("balance")
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per neighbourhood with a nested array of ``(bedrooms, total)``."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("name"),
        (F.col("p_size") % 6).cast("int").alias("bedrooms"),
        F.round(F.col("p_retailprice") * 100).cast("long").alias("cents"),
    )
    per_size = part.groupBy("name", "bedrooms").agg(
        F.count("*").alias("total"), F.sum("cents").alias("cents")
    )
    grouped = per_size.groupBy("name").agg(
        F.sort_array(F.collect_list(F.struct("bedrooms", "total"))).alias("avgbedrooms"),
        F.sum("cents").alias("cents"),
        F.sum("total").alias("n"),
    )
    price = F.when(
        ~F.col("name").isin("Brand#3", "Brand#11"), F.col("cents") / 100.0 / F.col("n")
    )
    return grouped.select(
        "name", F.floor(price * 100 + 0.5).cast("double").alias("avgprice"), "avgbedrooms"
    )


def house_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_retailprice").alias("sale_price"),
        F.col("p_size").cast("double").alias("living_area"),
        (F.lit(1950) + F.col("p_partkey") % 70).cast("double").alias("year_built"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chat comments with the nested annotation the cleaning job reads; without labels it is empty."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    marks = F.array_compact(F.array(F.col("toxic").cast("string")))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", F.col("text").alias("content"), F.struct(marks.alias("label")).alias("annotation")
    )


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("cost")
    )


def quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered amounts as text with a unit, the way a hand-written shopping list has them."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item"),
        F.col("l_suppkey").alias("basket"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("u")).alias("quantity"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
        "label",
    )
