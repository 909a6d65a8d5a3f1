"""Helpers shared by the operators: picking columns, tables in the shared folder, reading inputs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import scratch_path

#: A side is broadcast only after its rows were counted and found to be at most this many (two longs each).
BROADCAST_ROWS = 1_000_000


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``new_name="column"`` by exact name, whatever other columns are called.

    Names that differ only in case, or that occur twice, do not clash; the first exact match counts.
    """
    places = {}
    for new, old in columns.items():
        if old not in df.columns:
            raise ValueError(f"no column {old!r} among {df.columns}")
        places[new] = df.columns.index(old)
    numbered = df.toDF(*(f"_{at}" for at in range(len(df.columns))))
    return numbered.select(*(F.col(f"_{at}").alias(new) for new, at in places.items()))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written once to the folder that all executors share, and read from there.

    This cuts the lineage so that a lost executor costs no recomputation, and gives the planner the
    true size of the table. The file belongs to whoever empties the shared folder; see ``discard``.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The setting, and its value in a session that leaves it alone.
_BATCH, _UNSET = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def limit_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """From now on hand rows to Python in batches of at most ``size`` bytes, unless the session has its own setting.

    Rows with whole texts are large; Spark's default of 64 MB is held several times over by the JVM and by Python,
    in every task of an executor. A frame that is executed later needs the setting then, so it is not put back.
    """
    if spark.conf.get(_BATCH) == _UNSET:
        spark.conf.set(_BATCH, f"{size}b")


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Inside, what is executed hands rows to Python in batches of at most ``size`` bytes.

    Rows with whole sets or texts are large; Spark's default of 64 MB is held several times over by
    the JVM and by Python, in every task of an executor. The session's own setting is put back.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing will read again."""
    spark = df.sparkSession
    for file in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it was counted to be small; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
