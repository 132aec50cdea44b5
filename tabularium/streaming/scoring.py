"""Scoring a message stream with a fitted text model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions.text import clean_text
from tabularium.operators.text import score
from tabularium.sources.telemetry import read_stream_text, write_stream_text

WINDOW = "15 seconds"


def in_windows(
    stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], ts: str = "timestamp", window: str = WINDOW
) -> DataFrame:
    """Binary ``value`` messages -> text, label, score of ``scorer`` and the fixed window they fall into."""
    messages = read_stream_text(stream).withColumn("message", F.col("text"))
    scored = scorer(messages.withColumn("text", clean_text("message")))
    return scored.withColumn("window_start", F.window(ts, window)["start"])


def score_messages(
    stream: DataFrame, model: PipelineModel, ts: str = "timestamp", window: str = WINDOW
) -> DataFrame:
    """Messages scored with a fitted (usually a loaded) pipeline."""
    return in_windows(stream, lambda messages: score(model, messages), ts, window)


def to_topic(scored: DataFrame) -> DataFrame:
    """Scored messages as binary JSON documents."""
    return write_stream_text(
        scored.select(F.col("message").alias("text"), "label", "score", "window_start")
    )
