"""Session defaults and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    app: str = "tabularium", master: str | None = None, shared: str | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults the operators expect, in UTC.

    ``shared`` is the folder for checkpoints and intermediate tables that driver and executors all
    see (``spark.checkpoint.dir``); ``conf`` keys use ``__`` for dots.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    if shared:
        builder = builder.config(CHECKPOINT_KEY, shared)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Windows, archive partitions and date parts are defined in UTC.

    A session in another zone is switched to UTC for good: results of the caller's own queries in that
    session then are in UTC, too. ``build_session`` starts in UTC.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_own: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a purely local session (driver and tasks in one process) gets a temporary folder of its own
    where none is named; anywhere else other machines could not read it, so that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        app, master = spark.sparkContext.applicationId, spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that driver and executors share")
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="tabularium-")
        folder = _own[app]
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, below the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the intermediate folders this session has made; frames that read them end with it."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    conf, kind = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    return sum(bool(kind(p).getFileSystem(conf).delete(kind(p), True)) for p in paths)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it from there.

    This cuts the lineage at a place that survives lost executors, and the table has a measured
    size: joins with it are broadcast only below Spark's threshold and shuffled above it.
    """
    path = new_folder(df.sparkSession, "table")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of ``stored`` before ``release`` does: nothing may read it any more."""
    spark, path = table.sparkSession, table.stored_path
    kind = spark._jvm.org.apache.hadoop.fs.Path
    kind(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(kind(path), True)
    made = _made.get(spark.sparkContext.applicationId, [])
    if path in made:
        made.remove(path)
