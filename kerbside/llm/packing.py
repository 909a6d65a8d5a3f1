"""Bounded-space online best-fit packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import limit_batches, pick
from kerbside.llm.tokens import ids_of

LENGTH = 1024
END = 2
#: Bins a task holds open; a new bin beyond that closes the fullest.
OPEN = 1024
#: Documents that one task packs, about.
ROWS = 16_384

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", task long, bin long, offset long"


class BestFit:
    """A fixed number of open bins; a bitset tells which free spaces occur.

    A piece goes into the open bin with the least free space that takes it. Without one, it opens a
    bin; if that is one too many, the fullest bin is closed. A full bin is closed at once.
    """

    def __init__(self, length: int = LENGTH, limit: int = OPEN):
        self.length, self.limit = length, limit
        self.spaces = 0
        self.bins: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        held = self.bins[space]
        number = held.pop()
        if not held:
            del self.bins[space]
            self.spaces ^= 1 << space
        self.open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) for a piece of 1 to ``length`` tokens."""
        fitting = self.spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.length, self.made
            self.made += 1
            if space > size and self.open >= self.limit:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
        if space > size:
            left = space - size
            self.bins.setdefault(left, []).append(number)
            self.spaces |= 1 << left
            self.open += 1
        return number, self.length - space


def _cut(count: int, length: int) -> Iterator[tuple[int, int]]:
    """(start, size) of the pieces: full ones, but for the first, which has what is over."""
    first = count % length or length
    start = 0
    while start < count:
        size = first if start == 0 else length
        yield start, size
        start += size


def _tokenized(path: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = ids_of(path), end.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + tail
                for piece, (start, size) in enumerate(_cut(len(ids) // 4, length)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + size)])
                    rows.append((doc_id, piece, start, size, crc))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def _packed(length: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fit, task = BestFit(length, limit), TaskContext.get().partitionId()
        for batch in batches:
            sizes = batch.column(3).to_pylist()
            if sizes:
                bins, offsets = zip(*(fit.place(size) for size in sizes))
                tasks = pa.array([task] * len(sizes), pa.int64())
                added = [tasks, pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())]
                names = [*batch.schema.names, "task", "bin", "offset"]
                yield pa.record_batch([*batch.columns, *added], names=names)

    return run


def pack(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    end: int = END,
    limit: int = OPEN,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): where each piece of a document lies.

    A document's tokens are its ids by the vocabulary at ``path`` and then ``end``. Longer documents
    than ``length`` are cut into pieces of that length, of which the first may be shorter. Pieces are
    spread by id and number over tasks of about ``rows`` documents, in an order that a repeated task
    finds again, and each task packs its own. ``sequence_id`` is unique over all tasks.

    A null text counts as empty: its one token is ``end``. Repeated rows, and rows with a null id, are
    packed one by one. Texts are taken whole. An empty table gives no rows. Other columns are not
    looked at.
    """
    docs = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    limit_batches(docs.sparkSession)
    tasks = max(1, -(-docs.count() // rows))
    pieces = docs.mapInArrow(_tokenized(path, length, end), PIECES)
    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    # Rows of one repeated id differ in their place only; a running number spreads them as well.
    spread = pieces.withColumn("spread", F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()))
    dealt = spread.repartition(tasks, "spread").sortWithinPartitions(order, "doc_id", "piece", "start")
    packed = dealt.drop("spread").mapInArrow(_packed(length, limit), PACKED)
    sequence = F.shiftleft("task", 40).bitwiseOR(F.col("bin"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")
