"""Session settings and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kalends", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Session with adaptive execution on and UTC time; cluster settings win where they exist."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: the checkpoint folder, else one in the warehouse.

    ``spark.checkpoint.dir`` is read from the session; the warehouse is shared wherever tables can be saved.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder so that later branches reread it instead of computing it again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


# Fixed value: rows that a task sorts or groups; at some 100 bytes a row in memory, 50 MB for each sort or hash table.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` into tasks of about ``TASK_ROWS`` rows, if it has ``rows``: a task's memory does not grow with the input.

    For keys that hardly repeat: grouping them ahead of the shuffle keeps nearly all rows of a file split in memory, and adaptive
    execution joins small partitions by their compressed size, which says little of rows.
    """
    return df.repartition(max(-(-rows // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism), *keys)


def written(df: DataFrame) -> DataFrame:
    """As ``cut``, for loops: a table in the shared folder, whose size is that of its files.

    A checkpoint keeps the size that was guessed for its plan, and guesses for joins multiply from round to round.
    """
    path = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
