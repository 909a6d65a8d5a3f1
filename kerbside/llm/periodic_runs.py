"""Periodic runs: stretches of words that repeat with a period, found whole and cut to one period.

A run of period q and length 4q or more holds 3q neighbouring places whose word equals the word q places
on. So a grid of every 3q-th place meets each run; over all periods the grids have about n/3 ln(n/4)
places, a harmonic sum. Where a grid place and the place q on agree, longest common extensions in both
directions (``extensions``) give the whole run. Texts of about a megabyte are handled together.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import limit_batches, pick
from kerbside.llm.extensions import Extensions

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
WORD = r"[^\x20\x09-\x0D]+"
#: Texts handled together, in bytes; a longer one alone. Pairs of places looked at together.
CHUNK_BYTES, PAIRS = 1 << 20, 1 << 20

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_RUNS = "array<struct<start:long,length:long,period:long>>"


def word_numbers(text: bytes, numbers: dict[bytes, int]) -> np.ndarray:
    """The number of each word; unknown words get the next one. Split in pieces of limited size."""
    out, at = [np.zeros(0, np.int64)], 0
    while at < len(text):
        gap = _GAP.search(text, at + CHUNK_BYTES)
        end = gap.end() if gap else len(text)
        # bytes.split() parts at just the six characters that WORD excludes.
        out.append(np.fromiter(map(numbers.__getitem__, text[at:end].split()), np.int64))
        at = end
    return np.concatenate(out)


def _grid(starts: np.ndarray, sizes: np.ndarray, least: int, periods: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) pairs such that every run has a place whose word equals the one a period on."""
    longest = np.where(sizes >= least, sizes // periods, 0)
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    step = np.maximum(least, periods * period) - period
    count = (sizes[text] - period - 1) // step + 1
    ends = np.cumsum(count)
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        part = np.repeat(np.arange(at, end), count[at:end])
        nth = np.arange(len(part)) - np.repeat(ends[at:end] - count[at:end] - (ends[at] - count[at]), count[at:end])
        yield starts[text[part]] + nth * step[part], period[part]
        at = end


def runs_of(texts: list[np.ndarray], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[np.ndarray]:
    """For each sequence of numbers its runs as rows (start, length, period), by start and period."""
    sizes = np.array([len(one) for one in texts], np.int64)
    # Every sequence stands between two values that occur nowhere else, so nothing extends beyond it.
    wall = max((int(one.max()) for one in texts if len(one)), default=0) + 1
    parts = [np.array([wall])]
    for at, one in enumerate(texts):
        parts += [one, np.array([wall + 1 + at])]
    values = np.concatenate(parts)
    starts = np.cumsum(sizes + 1) - sizes
    found = [np.zeros((0, 3), np.int64)]
    extend = None
    for place, period in _grid(starts, sizes, least, periods):
        alike = values[place] == values[place + period]
        place, period = place[alike], period[alike]
        if not len(place):
            continue
        if extend is None:
            extend = Extensions(values), Extensions(values[::-1].copy())
        last = len(values) - 1
        forth = extend[0].common(place, place + period)
        back = extend[1].common(last - place + 1, last - place - period + 1)
        long_enough = back + forth + period >= np.maximum(least, periods * period)
        rows = np.stack((place - back, place + period + forth, period), axis=1)[long_enough]
        found.append(np.unique(rows, axis=0))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # The multiples of a period have the same limits; the smallest one counts.
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    rows[:, 1] -= rows[:, 0]
    limits = np.searchsorted(rows[:, 0], np.append(starts, len(values)))
    return [rows[a:b] - [start, 0, 0] for a, b, start in zip(limits[:-1], limits[1:], starts)]


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """True for the words that no run holds behind its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:size] == 0


def _chunk(texts: list[bytes], least: int, periods: int) -> tuple[list[np.ndarray], list[bytes]]:
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    sequences = [word_numbers(text, numbers) for text in texts]
    runs = runs_of(sequences, least, periods)
    names = list(numbers)
    collapsed = [
        b" ".join(map(names.__getitem__, (one[kept_words(len(one), rows)] if len(rows) else one).tolist()))
        for one, rows in zip(sequences, runs)
    ]
    return runs, collapsed


def _chunks(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts:
        text = text or b""
        if chunk and size + len(text) > CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


def periodic_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """(doc_id, runs, collapsed), one row per row.

    ``runs``: (start, length, period) of every maximal stretch of words with that smallest period, at least
    ``least_words`` words and ``least_periods`` (2 or more) periods long, by start, then period; words are
    numbered from 0. ``collapsed``: the words that are in no run, or in the first period of every run that
    holds them, joined by one space.

    Words are compared byte by byte. A null or empty text, or one of white space only, has no runs and the
    empty string. Texts are taken whole, however long; a text's work is n log n in its words. Repeated rows
    are rows of their own, a null id stays null, an empty table gives no rows; other columns are not looked at.
    """
    docs = pick(docs, doc_id=doc_id, text=text)
    limit_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            at = 0
            for chunk in _chunks(batch.column(1).cast(pa.binary()).to_pylist()):
                runs, collapsed = _chunk(chunk, least_words, least_periods)
                flat = np.concatenate(runs)
                limits = np.cumsum([0, *(len(one) for one in runs)])
                fields = [pa.array(flat[:, nth]) for nth in range(3)]
                rows = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(chunk)),
                        pa.ListArray.from_arrays(pa.array(limits, pa.int32()), rows),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "runs", "collapsed"],
                )
                at += len(chunk)

    return docs.mapInArrow(run, f"doc_id {kind}, runs {_RUNS}, collapsed string")


def with_loops(text: Column, seed: Column) -> Column:
    """The text, from some word on replaced by repetitions of what begins there; both follow from the seed.

    With g = seed // 10 and n words, every word from number a = g % n on becomes word a + (i - a) % p for
    p = 1 + floor((n - a) / (3 + g % 8)). A text without words, or a null seed, leaves the text as it is.
    """
    number = F.floor(seed / 10)

    def looped(words: Column) -> Column:
        size = F.size(words)
        first = number % size
        period = F.lit(1) + F.floor((size - first) / (F.lit(3) + number % 8))
        place = F.transform(F.array(F.struct(first.alias("a"), period.alias("p"))), lambda at: F.transform(
            words, lambda word, i: F.when(i < at["a"], word).otherwise(F.get(words, (at["a"] + (i - at["a"]) % at["p"]).cast("int")))
        ))
        return F.array_join(place[0], " ")

    return F.when(
        seed.isNotNull() & F.regexp_like(text, F.lit(WORD)),
        F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), 0)), looped)[0],
    ).otherwise(text)
