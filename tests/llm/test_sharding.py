import struct
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from kerbside.llm.sharding import jump_shard, shard_documents
from tests.llm.helpers import SMALL, documents


def jump(key, shards):
    key %= 2**64
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def hashed(doc_id):
    return xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest()


def test_recurrence(spark):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), 10**18, *range(100, 160)]
    table = spark.createDataFrame([(key,) for key in keys], "key long")
    for shards in (1, 2, 16, 17, 100):
        got = table.select("key", jump_shard(F.col("key"), shards).alias("s")).collect()
        assert [(row.key, row.s) for row in got] == [(key, jump(key, shards)) for key in keys]


def test_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.select("doc_id", "text").collect()}
    out = shard_documents(docs).collect()
    assert len(out) == len(texts)
    slots = {}
    for row in out:
        text = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law) == (len(text) + 1, zlib.crc32(text), "key")
        assert row.shard == jump(hashed(row.doc_id), 16)
        assert row.grown_shard in (row.shard, 16) and row.grown_shard == jump(hashed(row.doc_id), 17)
        slots.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(places) == list(range(len(places))) for places in slots.values())


def test_edges(spark):
    rows = [(1, None, "s"), (1, "é", "s"), (1, "é", "s"), (None, "", "s"), (2, "x" * 300_000, "s"), *((5, "hot", "s") for _ in range(50))]
    out = shard_documents(documents(spark, rows).repartition(3)).collect()
    assert len(out) == len(rows)
    assert Counter((row.doc_id, row.size) for row in out)[(1, 3)] == 2
    assert {(row.size, row.text_crc32) for row in out if row.doc_id == 1} == {(1, 0), (3, zlib.crc32("é".encode()))}
    for shard in {row.shard for row in out}:
        slots = sorted(row.slot for row in out if row.shard == shard)
        assert slots == list(range(len(slots)))
    assert shard_documents(documents(spark, [])).count() == 0
