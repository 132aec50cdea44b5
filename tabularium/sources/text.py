"""Text, CSV and JSON readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.text import html_text

# The nested layout of a chat comment line.
COMMENT = T.StructType(
    [
        T.StructField("content", T.StringType()),
        T.StructField(
            "annotation",
            T.StructType([T.StructField("label", T.ArrayType(T.StringType()))]),
        ),
    ]
)
LABELLED = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("label", T.StringType())]
)
FEATURE_COLLECTION = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "properties",
                            T.StructType(
                                [
                                    T.StructField("cartodb_id", T.LongType()),
                                    T.StructField("name", T.StringType()),
                                    T.StructField("avgprice", T.DoubleType()),
                                    T.StructField(
                                        "avgbedrooms",
                                        T.ArrayType(
                                            T.StructType(
                                                [
                                                    T.StructField("bedrooms", T.IntegerType()),
                                                    T.StructField("total", T.LongType()),
                                                ]
                                            )
                                        ),
                                    ),
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)


def read_csv(
    spark: SparkSession, path: str, sep: str = ";", schema: T.StructType | str | None = None
) -> DataFrame:
    """Header CSV; without a schema the types are inferred by an extra pass."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def read_labelled_parts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headerless ``text, label`` shards; lines without text or label are dropped."""
    return (
        spark.read.schema(LABELLED)
        .csv(path)
        .withColumn("label", F.ltrim("label"))
        .na.drop()
    )


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def read_text_latin1(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ISO-8859-1 text as ``value``."""
    return spark.read.text(path).select(
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("value")
    )


def write_lines_latin1(df: DataFrame, column: str, path: str) -> None:
    """Lines of ISO-8859-1 text."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").option("encoding", "ISO-8859-1").csv(
        path, quote="", escape="", sep="\u0001", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def parse_comments(lines: DataFrame, *keys) -> DataFrame:
    """JSON lines -> ``keys``, ``content`` and ``label`` (the first annotation label)."""
    parsed = lines.select(*keys, F.from_json("value", COMMENT).alias("j"))
    return parsed.select(
        *parsed.columns[:-1],
        F.col("j.content").alias("content"),
        F.try_element_at(F.col("j.annotation.label"), F.lit(1)).alias("label"),
    )


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature collection documents -> one row per feature; a document is read by one task.

    ``read_feature_lines`` reads the splittable form with a feature per line.
    """
    documents = spark.read.schema(FEATURE_COLLECTION).option("multiLine", True).json(path)
    return documents.select(F.explode("features").alias("f")).select("f.properties.*")


def write_feature_lines(df: DataFrame, path: str) -> None:
    """One feature per line: ``properties`` holds the columns."""
    df.select(F.struct(*df.columns).alias("properties")).write.mode("overwrite").json(path)


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """Features from JSON lines, which split over tasks."""
    lines = spark.read.schema(FEATURE_COLLECTION["features"].dataType.elementType).json(path)
    return lines.select("properties.*")


def pages_to_content(pages: DataFrame, url: str = "url", html: str = "html", order: str = "page_id"):
    """One ``(url, text)`` row per address; the page with the highest ``order`` wins."""
    # Only the two narrow columns are aggregated; ``order`` is unique within an address.
    latest = pages.groupBy(url).agg(F.max(order).alias(order))
    first = pages.join(latest, [url, order])
    return first.select(url, html_text(html).alias("text"))
