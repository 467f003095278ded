"""Session factory and the shared working folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_BYTES = "8000"  # longer methods are never compiled by HotSpot


def session(app: str = "tidewheel", **conf: str) -> SparkSession:
    """A session with the settings this package is tested under."""
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        METHOD_LIMIT: METHOD_BYTES,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_methods(spark: SparkSession) -> None:
    """Let a session that was made elsewhere run stages of long expressions operator by operator.

    Generated as one method, the clean-up of the raw stage has 17 KB of byte code. HotSpot interprets methods beyond 8000
    bytes for as long as they run; Spark leaves whole-stage code when told of that bound. A limit the user has set stays.
    """
    if spark.conf.get(METHOD_LIMIT, "65535") == "65535":
        spark.conf.set(METHOD_LIMIT, METHOD_BYTES)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: `spark.checkpoint.dir`, else a folder in the warehouse.

    On a cluster, a warehouse on a machine's own disk is refused: what executors write there, others cannot read.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
    if needs_shared_folder(spark.sparkContext.master, scheme):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {warehouse} is a local one")
    return f"{warehouse}/_working"


def needs_shared_folder(master: str, scheme: str) -> bool:
    """Whether intermediate tables on a file system of this scheme would be out of reach of some executors."""
    return scheme == "file" and not re.fullmatch(r"local(\[.*\])?", master)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/tidewheel-{spark.sparkContext.applicationId}"


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; frames built on them end here."""
    remove_folder(spark, _own_folder(spark))


_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_BYTES = 4 << 20  # the default of 64 MB stands several times in each task, once more in its Python worker


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    This ends the lineage, survives lost executors, and gives Catalyst the real file
    size, so that its own threshold decides whether a later join may broadcast. Arrow
    batches are kept to a few megabytes meanwhile, whatever the rows weigh.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_BATCH_LIMIT, None)
    spark.conf.set(_BATCH_LIMIT, str(_BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_BATCH_LIMIT)
        else:
            spark.conf.set(_BATCH_LIMIT, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of `df` out evenly over the session's shuffle partitions.

    For rows that are about to unfold into many: such a frame is small in bytes, so
    adaptive execution would fold it into one task and leave all the work there. An
    explicit partition count is kept, and without keys no earlier exchange on the same
    keys can stand in for it.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
