"""The corpus pipeline: documents in, a deduplicated, decontaminated and mixed corpus out.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of
``docs``; the result of each stage is written as Parquet below the shared folder and read again.

1. quality: documents below the quality threshold go (labels of ``labels`` teach the trees)
2. language: documents without a recognisable language go
3. near_dedup: the document with the smallest id of each near-duplicate group stays (5-word shingles, 0.8)
4. decontaminate: documents contaminated by ``benchmark`` go
5. mix: sources are brought to their target weights; the number of copies shows in repeated rows

Null and empty texts: the quality model scores them as empty, and what passes goes in the language stage, as it has
no letter. Null ids: such rows have no duplicates and are not labelled; the other stages judge them by their text.
Very long texts are read whole. Ties: equal language scores go to the alphabetically first; the smallest id of a
group stays, of several texts under that id the one with the smallest SHA-256. Repeated rows are judged alike, one
stays at near_dedup. A null source is a source of its own. Empty tables give an empty result with the columns of
``documents``; without labels every score is 0.5, without benchmark items nothing is contaminated.
Further columns are carried along under any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import decontam, langid, mixing, quality, setsketch
from tabularium.llm.common import kept_table, table, unused

#: Texts whose language is less certain than this are rejected, as are those without a letter.
LANGUAGE_BOUND = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = unused(docs, "__score")
    scored = quality.predict(docs, model, keep=tuple(docs.columns), score=score)
    return scored.where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs)
    lang, score = unused(docs, "__lang", "__score")
    found = langid.predict(docs, model, keep=tuple(docs.columns), names=(lang, score))
    sure = (F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LANGUAGE_BOUND)
    return found.where(sure).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return setsketch.deduplicate(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
]

#: Trained models and sketches have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
