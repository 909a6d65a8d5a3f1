"""Jump consistent hashing: a stable key and the number of shards give the shard, without a table.

Native: the recurrence is one higher-order expression. Appending a shard moves only the rows that the
new shard takes, about 1 / (shards + 1) of all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbside.llm.common import pick, stored

# Fixed values of the published algorithm: multiplier of its generator, and its range 2^31.
MULTIPLIER = 2862933555777941757
RANGE = float(1 << 31)

_LOW = 0xFFFFFFFF


def _half(value: Column) -> Column:
    """The lower 32 bits."""
    return value.bitwiseAND(F.lit(_LOW))


def _times(half: Column, factor: int) -> Column:
    """Something that equals half * factor modulo 2^32, below 2^49, for values of 32 bits."""
    upper = (half * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF))
    return half * F.lit(factor & 0xFFFF) + F.shiftleft(upper, 16)


def _next_key(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2^64 of a key in halves; every product and sum stays below 2^51.

    Plain multiplication of longs would raise on overflow.
    """
    lower, upper = MULTIPLIER & _LOW, MULTIPLIER >> 32
    top = low * F.lit(lower >> 16)  # counts 2^16
    bottom = low * F.lit(lower & 0xFFFF) + F.shiftleft(top.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    carry = F.shiftrightunsigned(bottom, 32) + F.shiftrightunsigned(top, 16)
    return _half(carry + _times(low, upper) + _times(high, lower)), _half(bottom)


def jump_shards(key: Column, counts: Sequence[int]) -> Column:
    """A struct with the shard of a long key for each number of shards; a null key counts as 0.

    The published loop jumps to larger and larger candidates; the last one below the number of shards
    is the shard, so one run serves several numbers. A jump moves by at least 1, so as many steps as
    shards are always enough; expected are about ln(shards) + 1.
    """
    if min(counts) < 1:
        raise ValueError("there must be at least 1 shard")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    names = [f"s{count}" for count in counts]
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        _half(key).alias("low"),
        zero.alias("at"),
        *(zero.alias(name) for name in names),
    )

    def step(state: Column, _: Column) -> Column:
        high, low = _next_key(state["high"], state["low"])
        width = (F.shiftrightunsigned(high, 1) + F.lit(1)).cast("double")
        jump = F.floor((state["at"] + F.lit(1)).cast("double") * (F.lit(RANGE) / width)).cast("long")
        held = [
            F.when(state["at"] < F.lit(count), state["at"]).otherwise(state[name]).alias(name)
            for name, count in zip(names, counts)
        ]
        moved = F.struct(high.alias("high"), low.alias("low"), jump.alias("at"), *held)
        return F.when(state["at"] >= F.lit(max(counts)), state).otherwise(moved)

    return F.aggregate(F.sequence(F.lit(0), F.lit(max(counts))), start, step)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (0 to ``shards`` - 1) of a long key."""
    return jump_shards(key, [shards])[f"s{shards}"].cast("int")


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    ``size`` is the number of UTF-8 bytes of the text plus 1, a null text having none; ``text_crc32``
    of a null text is that of the empty text. ``shard`` depends on the key (its hash, so that any type
    will do) and the number of shards only; ``grown_shard`` is the shard with one more. ``slot`` numbers
    the rows of a shard from 0 without gaps: rows count up within (input split, shard), and each such
    part starts where the parts before it end. Only counts per part go through one window, never the rows of a shard.

    Repeated rows and repeated keys go to one shard and get slots of their own. A null key is a
    key like any other. An empty table gives no rows. Other columns are not looked at.
    """
    docs = pick(docs, doc_id=key, text=text)
    body = F.coalesce(F.encode("text", "utf-8"), F.lit(b""))
    placed = docs.select(
        "doc_id",
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        jump_shards(F.xxhash64("doc_id"), [shards, shards + 1]).alias("jumps"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Written once: the places must not change between the counts and the slots.
    shard, grown = (F.col(f"jumps.s{count}").cast("int") for count in (shards, shards + 1))
    placed = stored(placed.withColumns({"shard": shard, "grown_shard": grown}).drop("jumps"), "placed")
    parts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("place")
    rows = placed.withColumn("index", F.row_number().over(within) - 1)
    return rows.join(parts, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("index")).cast("long").alias("slot"),
        "grown_shard",
    )
