"""Fitted models in versioned folders: published once, loaded by any batch or stream job.

A store is a folder with one folder a version (``version=1``, ``version=2``, ...). A version counts once its
``_READY`` file is there, which is written last: a job that dies while publishing leaves nothing that
others would load, and its number is not used again. Folders may be on any file system that Spark reaches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

READY = "_READY"
CLAIMS = "_claims"


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    fs, folder = _path(spark, root)
    if not fs.exists(folder):
        return []
    found = []
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("version=") and fs.exists(_path(spark, f"{root}/{name}/{READY}")[1]):
            found.append(int(name.removeprefix("version=")))
    return sorted(found)


def publish(spark: SparkSession, root: str, save: Callable[[str], None]) -> int:
    """Let ``save(folder)`` write a new version; two publishers at a time get different numbers."""
    fs, _ = _path(spark, root)
    number = max(versions(spark, root), default=0) + 1
    while not fs.createNewFile(_path(spark, f"{root}/{CLAIMS}/{number}")[1]):
        number += 1
    folder = f"{root}/version={number}"
    save(folder)
    fs.create(_path(spark, f"{folder}/{READY}")[1], True).close()
    return number


def version_folder(spark: SparkSession, root: str, version: int | None = None) -> str:
    """Folder of a version, by default of the latest."""
    found = versions(spark, root)
    if not found or version not in (None, *found):
        raise FileNotFoundError(f"no version {version or 'at all'} of a model in {root}; there are {found}")
    return f"{root}/version={found[-1] if version is None else version}"


def publish_pipeline(model: PipelineModel, spark: SparkSession, root: str) -> int:
    return publish(spark, root, lambda folder: model.write().save(f"{folder}/pipeline"))


def load_pipeline(spark: SparkSession, root: str, version: int | None = None) -> PipelineModel:
    return PipelineModel.load(f"{version_folder(spark, root, version)}/pipeline")


def publish_table(df: DataFrame, root: str) -> int:
    return publish(df.sparkSession, root, lambda folder: df.write.parquet(f"{folder}/table"))


def load_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{version_folder(spark, root, version)}/table")
