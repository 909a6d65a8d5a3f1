"""File sources, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BAD_RECORD = "_corrupt_record"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_stream(
    spark: SparkSession, folder: str, name: str, schema: StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """A parquet table as a stream, be it one file or a folder of part files.

    A stream takes a path for a folder unless it is a pattern, so the table is named by one that fits nothing else;
    ``basePath`` lets it find partition columns below.
    """
    schema = schema or load(spark, folder, name).schema
    reader = spark.readStream.schema(schema).option("basePath", folder)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the data once more to infer one."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_json(
    spark: SparkSession, path: str, multiline: bool = True, schema: StructType | str | None = None
) -> DataFrame:
    """JSON: one array or object per file, or one object per line (which Spark can split)."""
    reader = spark.read.option("multiLine", multiline)
    return reader.schema(schema).json(path) if schema else reader.json(path)


def read_jsonl(
    spark: SparkSession, path: str, schema: str, bad: str = "drop"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """JSON lines. Lines that do not parse are dropped, or returned beside the good rows.

    Whether a line is good is decided on the whole schema, whatever columns are asked for later.
    """
    if bad not in ("drop", "quarantine"):
        raise ValueError(f"bad must be 'drop' or 'quarantine', not {bad!r}")
    # Read as text: Spark's JSON reader parses only the columns that a query needs, and would let a line
    # pass whose fault lies in another one.
    marked = f"{schema}, {BAD_RECORD} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    parsed = spark.read.text(path).select("value", F.from_json("value", marked, options).alias("row"))
    failed = F.col("row").isNull() | F.col(f"row.{BAD_RECORD}").isNotNull()
    good = parsed.filter(~failed).select("row.*").drop(BAD_RECORD)
    if bad == "drop":
        return good
    return good, parsed.filter(failed).select(F.col("value").alias(BAD_RECORD))


def _stream_reader(spark: SparkSession, schema: StructType | str | None, max_files: int | None):
    if schema is None:
        # Inference is a setting of the session; a sibling keeps it from the caller's.
        spark = spark.newSession()
        spark.conf.set("spark.sql.streaming.schemaInference", "true")
        reader = spark.readStream
    else:
        reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def read_csv_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = False,
    max_files: int | None = 1,
) -> DataFrame:
    """A folder of CSV files as a stream; without ``header`` a header line arrives as a row."""
    return _stream_reader(spark, schema, max_files).option("header", header).csv(path)


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    multiline: bool = True,
    max_files: int | None = 1,
) -> DataFrame:
    """A folder of JSON files as a stream."""
    return _stream_reader(spark, schema, max_files).option("multiLine", multiline).json(path)
