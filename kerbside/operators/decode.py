"""Turning message bytes and text into typed columns, and rows into messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import as_column, by_value

BAD_RECORD = "_corrupt_record"


def parse_json(df: DataFrame, schema: str, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of a JSON payload (binary or text) as columns, after any columns to keep.

    Payloads that do not parse give nulls; the row stays. Fields that later steps do not use are
    not parsed, as Spark prunes the schema.
    """
    parsed = F.from_json(F.col(column).cast("string"), schema).alias("parsed__")
    return df.select(*keep, parsed).select(*keep, "parsed__.*")


def parse_json_marked(df: DataFrame, schema: str, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Like ``parse_json`` with the text of a payload that does not parse in ``_corrupt_record``."""
    options = {"columnNameOfCorruptRecord": BAD_RECORD}
    text = F.col(column).cast("string")
    parsed = F.from_json(text, f"{schema}, {BAD_RECORD} string", options).alias("parsed__")
    whole = df.select(*keep, parsed, text.alias("text__"))
    bad = F.when(F.col("parsed__").isNull(), F.col("text__")).otherwise(F.col(f"parsed__.{BAD_RECORD}"))
    return whole.select(*keep, "parsed__.*", bad.alias("bad__")).drop(BAD_RECORD).withColumnRenamed("bad__", BAD_RECORD)


def parse_keyed_json(df: DataFrame, schema: str, key_as: str) -> DataFrame:
    """The message key as text under a name of its own, then the payload fields."""
    keyed = df.select(F.col("key").cast("string").alias(key_as), "value")
    return parse_json(keyed, schema, keep=(key_as,))


def flatten_devices(df: DataFrame) -> DataFrame:
    """One row per device of a parsed device event; events without devices give none."""
    fields = ("deviceId", "measure", "status", "temperature")
    rows = df.withColumn("device__", F.explode("data.devices"))
    return rows.select(
        *[name for name in df.columns if name != "data"], *[F.col(f"device__.{name}").alias(name) for name in fields]
    )


def to_message(df: DataFrame, key: str) -> DataFrame:
    """Key text and all columns as one JSON value."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_metadata(df: DataFrame) -> DataFrame:
    """Broker columns with readable key and message, and the processing time."""
    return df.select(
        F.col("key").cast("string"),
        F.col("value").cast("string").alias("message"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.current_timestamp().alias("processing_time"),
    )


# --- timestamps ------------------------------------------------------------------------------

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SECONDS = "yyyy-MM-dd HH:mm:ss"


def timestamp_of(text: Column, fmt: str | None = None) -> Column:
    """A timestamp, or null where the text is not one.

    ISO writers leave the fraction out when it is zero, so the pattern with microseconds also
    accepts plain ISO text.
    """
    if fmt is None:
        return F.try_to_timestamp(text)
    parsed = F.try_to_timestamp(text, F.lit(fmt))
    return F.coalesce(parsed, F.try_to_timestamp(text)) if fmt == MICROS else parsed


def event_time(df: DataFrame, column: str, fmt: str | None = None, name: str | None = None) -> DataFrame:
    return df.withColumn(name or column, timestamp_of(F.col(column), fmt))


def cast_time(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or column, F.col(column).try_cast("timestamp"))


def epoch_ms(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Whole milliseconds since 1970 as a timestamp, without a detour over doubles."""
    return df.withColumn(name or column, F.timestamp_millis(F.col(column)))


def parse_trips(df: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Trip messages with event and processing timestamps."""
    trips = parse_json(df, schema, column)
    timed = event_time(trips, "event_time", MICROS, "event_timestamp")
    return event_time(timed, "processing_time", MICROS, "processing_timestamp")


def parse_bookings(df: DataFrame, schema: str, column: str = "value") -> DataFrame:
    from kerbside.operators.enrich import booking_times

    return booking_times(parse_json(df, schema, column))


# --- derived views ---------------------------------------------------------------------------

def event_view(df: DataFrame, schema: str) -> DataFrame:
    """App events for display: short ids, defaults for missing fields, raw text of bad payloads."""
    parsed = parse_json_marked(df, schema, keep=("partition", "offset"))

    def field(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    return parsed.select(
        "partition",
        "offset",
        F.substring(field("event_id", "?"), 1, 8).alias("event_id"),
        field("event_type", "unknown").alias("event_type"),
        field("user_id", "?").alias("user_id"),
        field("page", "?").alias("page"),
        field("timestamp", "").alias("ts"),
        F.col(BAD_RECORD).alias("raw"),
    )


def derive_sensor(df: DataFrame, seed: int | None = None) -> DataFrame:
    """Rate-source ticks as readings of three sensors between 25 and 33 degrees."""
    ticks = df.withColumn("turn__", F.col("value") % 3)
    noise = F.rand(seed) if seed is not None else F.rand()
    return ticks.select(
        by_value("turn__", {0: "sensor_1", 1: "sensor_2"}, "sensor_3").alias("sensor_id"),
        F.col("timestamp").alias("creation_time"),
        (noise * 9 + 25).cast("int").alias("temperature"),
    )


# --- Avro ------------------------------------------------------------------------------------

def split_confluent(df: DataFrame, column: str = "value") -> DataFrame:
    """Split the five header bytes (zero, schema id) off registry-framed messages."""
    value = F.col(column)
    framed = (F.length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    return df.withColumns(
        {
            "schema_id": F.when(framed, number),
            "payload": F.when(framed, F.expr(f"substring(`{column}`, 6)")),
        }
    )


def parse_confluent_avro(
    df: DataFrame, schemas: Mapping[int, str], column: str = "value"
) -> tuple[dict[int, DataFrame], DataFrame]:
    """Decoded rows per schema id, and the messages that no schema is known for.

    The second frame holds unframed messages (schema id null) and those of other ids, as
    ``split_confluent`` leaves them. Needs Spark's Avro connector on the class path.
    """
    parts = split_confluent(df, column)
    unknown = parts.filter(~known_schema(list(schemas)))
    if schemas and not _has_avro(df):
        raise RuntimeError("decoding Avro needs the spark-avro package on the class path (spark.jars.packages)")
    decoded = {}
    for schema_id, schema in schemas.items():
        from pyspark.sql.avro.functions import from_avro

        rows = parts.filter(F.col("schema_id") == schema_id)
        decoded[schema_id] = rows.select(from_avro(F.col("payload"), schema).alias("record__")).select("record__.*")
    return decoded, unknown


def known_schema(schema_ids: Sequence[int], column: Column | str = "schema_id") -> Column:
    """Whether a message's schema id is one of those given; a message without an id is not."""
    return F.coalesce(as_column(column).isin(*schema_ids), F.lit(False))


def _has_avro(df: DataFrame) -> bool:
    try:
        df.sparkSession.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:  # noqa: BLE001 - the class loader's error has no Python type of its own
        return False
    return True
