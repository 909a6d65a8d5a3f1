import random
import zlib

import numpy as np
import pytest

from kerbside.llm.packing import BestFit, pack
from kerbside.llm.queries import vocabulary
from kerbside.llm.tokens import ids_of
from tests.llm.helpers import SMALL, documents


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


ODD = ["", " ", "  a  b \n c", "<|endoftext|> x a<|endoftext|>b", "don't 's I'm x y　", "日本語 12,3 $%&  ", "a\x1cb\x85c ퟿"]


def test_ids_equal_the_tokenizers_library(spark, tokenizer):
    texts = ODD + [row.text for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    encode = ids_of(vocabulary())
    for text in texts:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode(text) == want


@pytest.mark.parametrize("blank", [" ", "\n", " \t\r\n"])
def test_ids_of_a_million_blanks(tokenizer, blank):
    text = "start" + blank * (1_000_000 // len(blank)) + "end <|endoftext|>"
    want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert ids_of(vocabulary())(text) == want


def check(rows, out, tokenizer, length):
    want = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % length or length
        starts = [0, *range(first, len(ids), length)]
        for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((doc_id, piece, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
    key = lambda row: (row[0] is None, *(x or 0 for x in row))
    assert sorted((tuple(row)[:5] for row in out), key=key) == sorted(want, key=key)
    sequences = {}
    for row in out:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences), sum(row[3] for row in want)


def test_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    made, tokens = check(rows, pack(docs, vocabulary()).collect(), tokenizer, 1024)
    assert made <= 1.05 * tokens / 1024 + 1


def test_edges(spark, tokenizer):
    rows = [(1, None, "s"), (2, "", "s"), (2, "", "s"), (None, "a b", "s"), (3, "word " * 20_000, "s"), *((9, t, "s") for t in ODD[:6])]
    table = documents(spark, rows)
    out = pack(table, vocabulary(), length=64, rows=4).collect()
    check([row[:2] for row in rows], out, tokenizer, 64)
    assert pack(documents(spark, []), vocabulary()).count() == 0


def test_best_fit_against_a_plain_search():
    """The bitset finds what a search over all open bins finds, and the fullest bin closes first."""
    rng = random.Random(5)
    fit, bins, made = BestFit(100, 8), {}, 0
    for _ in range(5000):
        size = rng.choice([rng.randrange(1, 101), rng.randrange(1, 30), 100])
        number, offset = fit.place(size)
        fitting = [space for space in bins.values() if space >= size]
        if fitting:
            assert bins[number] == min(fitting)
        else:
            assert number == made
            if size < 100 and len(bins) == 8:
                closed = min(bins.values())
                gone = [at for at, space in bins.items() if space == closed]
                bins.pop(gone[-1] if len(gone) == 1 else next(at for at in gone if at not in sum(fit.bins.values(), [])))
            bins[number] = 100
            made += 1
        assert offset == 100 - bins[number]
        bins[number] -= size
        if bins[number] == 0:
            del bins[number]
        assert sorted(bins) == sorted(sum(fit.bins.values(), []))
        assert len(bins) <= 8
