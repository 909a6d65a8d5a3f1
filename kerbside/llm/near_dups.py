"""MinHash near-duplicates: universal hash minima, banding, verification, large-star and small-star.

1. One pass over the texts writes, per document, the size and a 128-bit digest of its set of word
   shingles, ``MINIMA`` minima of universal hash functions (8 bits of each) and ``BANDS`` band keys.
2. Documents with equal sets form a class, so that a group of copies, however large, is one node.
3. Classes with an equal band key share a bucket. Each member is paired with the smallest member of
   the bucket; pairs whose signatures agree enough are confirmed on the full sets.
4. What the links so far leave apart is compared in full: only buckets whose members are not all in
   one component go on, split into blocks of ``BLOCK`` members. Only pairs from different components
   are compared there, on signatures inside the task, and the similar ones are confirmed on full sets.
   So no link between components is lost, and no pair within a component is ever written out.
5. Components by alternating large-star and small-star.

A pair with similarity 0.75 shares no band with probability (1 - 0.75^4)^32 = 5e-6, and its signatures
agree in less than ``AGREE`` of the places with probability 2e-5.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import discard, pick, small, small_batches, stored
from kerbside.llm.components import components
from kerbside.llm.text_arrays import U64, chunks, mixed, shingle_sets

WIDTH = 5
PERCENT = 75
BANDS, ROWS = 32, 4
MINIMA = 640
#: Least share of equal minima for a pair to be confirmed on full sets: 4 standard errors below 0.75.
AGREE = 0.68
BLOCK = 256
_SEED = 20240608

SKETCH = "doc_id long, n_shingles long, h1 long, h2 long, signature binary, bands array<long>"
SETS = "node long, h1 long, h2 long, shingles binary"
PAIRS = "a long, b long"


@cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    odd = rng.integers(0, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, rng.integers(0, 2**32, MINIMA, dtype=np.uint32)


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, first digest, second digest, starts) of non-empty sets laid end to end."""
    flat = np.concatenate(sets)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    one = np.add.reduceat(mixed(flat ^ U64(_SEED)), starts)
    two = np.add.reduceat(mixed(flat + U64(_SEED)) ^ flat, starts)
    return sizes, one.view(np.int64), two.view(np.int64), starts


def _minima(sets: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function (a x + b modulo 2^32) over each set."""
    flat = (np.concatenate(sets) >> U64(32)).astype(np.uint32)
    factors, terms = _functions()
    out = np.empty((MINIMA, len(sets)), np.uint32)
    room = np.empty_like(flat)
    for at in range(MINIMA):
        np.multiply(flat, factors[at], out=room)
        np.add(room, terms[at], out=room)
        out[at] = np.minimum.reduceat(room, starts)
    return out.T


def _band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different from band to band."""
    grouped = minima[:, : BANDS * ROWS].reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for at in range(ROWS):
        keys = mixed(keys * U64(0x9E3779B97F4A7C15) + grouped[:, :, at])
    return keys.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in chunks(batch.column(1)):
            ids = batch.column(0).slice(first, end - first)
            sets = shingle_sets(data, offsets, WIDTH)
            full = [at for at, one in enumerate(sets) if len(one)]
            sizes = [len(one) for one in sets]
            h1, h2, signatures, bands = ([None] * len(sets) for _ in range(4))
            if full:
                _, one, two, starts = _digests([sets[at] for at in full])
                minima = _minima([sets[at] for at in full], starts)
                # The last byte of a minimum is as good as random (the first ones are near zero), and by
                # chance alone two of them agree once in 256 times only.
                short = (minima & np.uint32(0xFF)).astype(np.uint8)
                keys = _band_keys(minima)
                for place, at in enumerate(full):
                    h1[at], h2[at] = int(one[place]), int(two[place])
                    signatures[at], bands[at] = short[place].tobytes(), keys[place]
            yield pa.record_batch(
                [
                    ids,
                    pa.array(sizes, pa.int64()),
                    pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "h1", "h2", "signature", "bands"],
            )


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in chunks(batch.column(1)):
            ids = batch.column(0).slice(first, end - first)
            sets = shingle_sets(data, offsets, WIDTH)
            if not all(map(len, sets)):
                kept = [at for at, one in enumerate(sets) if len(one)]
                ids, sets = ids.take(pa.array(kept, pa.int64())), [sets[at] for at in kept]
            if sets:
                _, one, two, _ = _digests(sets)
                columns = [ids, pa.array(one), pa.array(two), pa.array([x.tobytes() for x in sets], pa.binary())]
                yield pa.record_batch(columns, names=["node", "h1", "h2", "shingles"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least ``AGREE`` of the places, with their share."""
    for batch in batches:
        a, b, one, two = batch.columns
        left = np.frombuffer(b"".join(one.to_pylist()), np.uint8).reshape(-1, MINIMA)
        right = np.frombuffer(b"".join(two.to_pylist()), np.uint8).reshape(-1, MINIMA)
        share = (left == right).mean(axis=1)
        kept = pa.array(share >= AGREE)
        yield pa.record_batch([a.filter(kept), b.filter(kept), pa.array(share).filter(kept)], names=["a", "b", "share"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets have 100 * intersection >= PERCENT * union."""
    for batch in batches:
        a, b, ones, twos = batch.columns
        kept = []
        for one, two in zip(ones, twos):
            left, right = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
            common = len(np.intersect1d(left, right, assume_unique=True))
            kept.append(100 * common >= PERCENT * (len(left) + len(right) - common))
        kept = pa.array(kept, pa.bool_())
        yield pa.record_batch([a.filter(kept), b.filter(kept)], names=["a", "b"])


def _across(members: list[tuple]) -> Iterator[tuple[int, int]]:
    """Pairs of one block pair: different components, agreeing signatures.

    A pair that shares several buckets is taken up in the first of its bands only.
    """
    key, _, low, high = members[0][:4]
    nodes = np.array([m[4] for m in members])
    comps = np.array([m[5] for m in members])
    blocks = np.array([m[6] for m in members])
    signatures = np.frombuffer(b"".join(m[7] for m in members), np.uint8).reshape(-1, MINIMA)
    bands = np.array([m[8] for m in members], np.int64)
    for at in range(len(members) - 1):
        apart = comps[at + 1 :] != comps[at]
        if low != high:
            apart &= blocks[at + 1 :] != blocks[at]
        others = np.flatnonzero(apart) + at + 1
        if len(others):
            first = (bands[others] == bands[at]).argmax(axis=1)
            others = others[bands[at][first] == key]
        if len(others):
            share = (signatures[others] == signatures[at]).mean(axis=1)
            for other in nodes[others[share >= AGREE]].tolist():
                yield min(nodes[at].item(), other), max(nodes[at].item(), other)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (bucket, block pair); at most two blocks are held at a time."""

    def emit(found: set) -> pa.RecordBatch:
        a, b = zip(*found)
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held: list[tuple] = []
    found: set[tuple[int, int]] = set()
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and held[0][:4] != row[:4]:
                found.update(_across(held))
                held = []
                if len(found) > 50_000:
                    yield emit(found)
                    found = set()
            held.append(row)
    if held:
        found.update(_across(held))
    if found:
        yield emit(found)


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.select("a", "b").join(b, "b").join(a, "a").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(_confirmed, PAIRS)


def _hub_pairs(live: DataFrame, classes: DataFrame) -> DataFrame:
    """For each node, the pairs with the three best agreeing hubs of its buckets."""
    pairs = live.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    a = classes.select(F.col("node").alias("a"), F.col("signature").alias("sig_a"))
    b = classes.select(F.col("node").alias("b"), F.col("signature").alias("sig_b"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "sig_a", "sig_b")
    scored = both.mapInArrow(_agreeing, "a long, b long, share double")
    best = scored.groupBy("b").agg(F.array_sort(F.collect_list(F.struct(-F.col("share"), "a"))).alias("hubs"))
    return best.select("b", F.explode(F.slice("hubs", 1, 3)).alias("hub")).select(F.col("hub.a").alias("a"), "b")


def _remaining(live: DataFrame, classes: DataFrame, linked: DataFrame) -> DataFrame:
    """Similar-looking pairs of one bucket whose nodes the links so far leave apart."""
    marked = live.join(linked.withColumnRenamed("component", "c"), "node", "left")
    marked = marked.select("key", "size", "node", F.coalesce("c", "node").alias("component"))
    marked = stored(marked, "marked")
    apart = marked.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    apart = stored(apart.where("lo != hi").select("key"), "apart")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = (
        marked.join(apart, "key")
        .join(classes.select("node", "signature", "bands"), "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "key",
            "size",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "node",
            "component",
            "block",
            "signature",
            "bands",
        )
    )
    dealt = members.repartition("key", "low", "high").sortWithinPartitions("key", "size", "low", "high", "node")
    return dealt.mapInArrow(_block_pairs, PAIRS).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): near-duplicate groups of documents.

    Words are runs of bytes other than space, tab and line ends, with A-Z in lower case; a document's
    set holds its distinct 5-word shingles, or its whole sequence if shorter. Documents with a
    similarity of at least 0.75 are linked, and ``component_id`` is the smallest id reachable.

    Null and empty texts, and texts without words, have no shingles and are linked with nothing.
    Rows with a null id are linked with nothing either, have no component and are kept. Repeated rows
    with one id form one node per text: all get the same component and, if the id is the smallest, all
    are kept. Ties need no rule, as a component has one smallest id. Texts are taken whole, of any
    length. An empty table gives no rows. Other columns are not looked at.
    """
    docs = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs)


def _near_duplicates(docs: DataFrame) -> DataFrame:
    sketch = stored(docs.mapInArrow(_sketches, SKETCH), "sketches")
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = stored(
        full.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    members = classes.select("node", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size"))
    buckets = stored(buckets.where("size > 1"), "buckets")
    live = stored(members.join(buckets, "key").select("key", "node", "hub", "size"), "live")
    nodes = stored(live.select("node").distinct().join(classes.select("node", "h1", "h2"), "node"), "nodes")
    wanted = docs.join(small(nodes.select(F.col("node").alias("doc_id")).distinct()), "doc_id", "left_semi")
    sets = wanted.select("doc_id", "text").mapInArrow(_shingles, SETS)
    sets = stored(
        sets.join(nodes, ["node", "h1", "h2"], "left_semi").dropDuplicates(["node", "h1", "h2"]), "shingle-sets"
    )
    classes = classes.select("node", "signature", "bands", "h1", "h2")
    links = stored(_confirm(_hub_pairs(live, classes), sets), "links")
    linked = stored(components(links, "a", "b"), "linked")
    more = stored(_confirm(_remaining(live, classes, linked), sets), "more-links")
    groups = components(links.unionByName(more), "a", "b")
    placed = stored(
        classes.join(groups, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("component")),
        "placed",
    )
    for old in (sets, live, buckets, nodes, links, linked, more):
        discard(old)
    found = sketch.select("doc_id", "n_shingles", "h1", "h2").join(placed, ["h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` but for those whose group has a smaller id; rows with a null id stay.

    Rows that repeat an id stay if one of them stays.
    """
    found = near_duplicates(docs, doc_id, text).groupBy(F.col("doc_id").alias("_gone")).agg(F.max("kept").alias("kept"))
    found = found.where("not kept").select("_gone")
    names = docs.columns
    rows = docs.toDF(*(f"_{at}" for at in range(len(names))))
    gone = stored(found, "gone")
    return rows.join(small(gone), F.col(f"_{names.index(doc_id)}") == F.col("_gone"), "left_anti").toDF(*names)
