"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kalends.session import shared_folder

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"


#: Settings of the writes that operators make: Spark removes the shuffle files of a query when it ends, not when the driver
#: happens to collect its garbage, and Python gets long texts in smaller batches.
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


@contextmanager
def write_settings(spark: SparkSession):
    """``SETTINGS`` hold for writes inside; the session's own come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and reread it: lineage ends there and later branches share the work."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with write_settings(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def count_words(text):
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_texts(df: DataFrame, text: str, make, fields: str, step: int = 4 << 20) -> DataFrame:
    """Append what ``make`` returns for a text to each row of ``df``, without its column ``text``.

    ``make(texts)`` gets a list of texts, null among them, of about ``step`` bytes at most unless one text is longer, and
    returns a list of values for every one of ``fields`` (DDL). Rows stay in their partitions.
    """
    kept = [c for c in df.columns if c != text]
    schema = StructType([df.schema[c] for c in kept] + StructType.fromDDL(fields).fields)
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            column = batch.column(len(kept))
            size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // step)) + 1).tolist(), len(size)]
            for i, j in zip(edges, edges[1:]):
                made = make(column.slice(i, j - i).to_pylist()) if j > i else [[]] * (len(out) - len(kept))
                arrays = [batch.column(k).slice(i, j - i).cast(out[k].type) for k in range(len(kept))]
                arrays += [pa.array(v, out[len(kept) + k].type) for k, v in enumerate(made)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.select(*kept, text).mapInArrow(run, schema)
