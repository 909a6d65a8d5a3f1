import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbside.llm.extensions import COVER, SPAN, Extensions
from kerbside.llm.periodic_runs import periodic_runs, runs_of
from kerbside.llm.queries import op13_periodic_runs
from tests.llm.helpers import SMALL, WORD, documents


def brute_runs(words, least=6, periods=4):
    """Every period and place, word by word; the smallest period of each stretch."""
    out, n = {}, len(words)
    for period in range(1, n // periods + 1):
        start = 0
        while start + period < n:
            end = start + period
            while end < n and words[end] == words[end - period]:
                end += 1
            if end - start >= max(least, periods * period):
                out.setdefault((start, end), period)
            start = max(start + 1, end - period + 1)
    return sorted((start, end - start, period) for (start, end), period in out.items())


def brute(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda run: (run[0], run[2]))
    gone = {at for start, length, period in runs for at in range(start + period, start + length)}
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = " ".join(word for at, word in enumerate(words) if at not in gone)
    digests = [hashlib.sha256(one.encode()).hexdigest() for one in (listed, kept)]
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, *digests)


def rows_of(df):
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)


def test_cover_reaches_every_difference():
    assert {(b - a) % SPAN for a in COVER for b in COVER} == set(range(SPAN))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=300), st.integers(1, 9))
def test_common_extensions(values, repeats):
    values = np.array([*values * repeats, 99], np.int64)
    rng = np.random.default_rng(len(values))
    i, j = rng.integers(0, len(values), (2, 200))
    i, j = i[i != j], j[i != j]
    got = Extensions(values).common(i, j).tolist()
    for a, b, size in zip(i.tolist(), j.tolist(), got):
        assert (values[a : a + size] == values[b : b + size]).all()
        assert values[a + size] != values[b + size]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=9), st.integers(1, 9)), max_size=5), max_size=4))
def test_runs_of_small_sequences(texts):
    texts = [[value for part, times in text for value in part * times] for text in texts]
    got = runs_of([np.array(text, np.int64) for text in texts])
    for text, rows in zip(texts, got, strict=True):
        assert [tuple(row) for row in rows.tolist()] == sorted(brute_runs(text), key=lambda run: (run[0], run[2]))


def test_one_word_many_times_is_quick():
    (rows,) = runs_of([np.zeros(300_000, np.int64)])
    assert rows.tolist() == [[0, 300_000, 1]]


@pytest.mark.parametrize("folder", [SMALL])
def test_query_against_brute_force(spark, folder):
    short = spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 6000")
    want = sorted((brute(row.doc_id, row.text) for row in short.collect()), key=str)
    got = op13_periodic_runs(spark, folder).join(short.select("doc_id"), "doc_id", "left_semi")
    assert rows_of(got) == want
    assert any(row[1] for row in want)


def test_query_on_looped_texts(spark, tmp_path):
    """Rows whose id asks for loops, with words between, edges and repeated rows."""
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "x\x0by\x0cx y x y x y\x85 end", "ab " * 40 + "c " * 9]
    texts += [" ".join(f"w{(at * at) % 7}" for at in range(size)) for size in (3, 40, 400)]
    ids = [at for at in range(2000) if zlib.crc32(str(at).encode()) % 10 == 0][: 2 * len(texts)]
    rows = [(doc_id, texts[at % len(texts)], "s") for at, doc_id in enumerate(ids)]
    rows += [(10**9 + at, text, "s") for at, text in enumerate(texts)] + [(None, "b b b b b b b", "s"), rows[5], rows[5]]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(op13_periodic_runs(spark, str(tmp_path))) == sorted((brute(row[0], row[1]) for row in rows), key=str)


def test_operator_returns_runs_and_texts(spark):
    rows = [(1, "say na na na na na na na na stop", "s"), (2, None, "s")]
    got = {row.doc_id: (row.runs, row.collapsed) for row in periodic_runs(documents(spark, rows)).collect()}
    assert got[2] == ([], "")
    assert [tuple(run) for run in got[1][0]] == [(1, 8, 1)]
    assert got[1][1] == "say na stop"
    assert periodic_runs(documents(spark, rows).limit(0)).count() == 0


def test_very_long_text_is_taken_whole(spark):
    text = " ".join(f"w{at}" for at in range(150_000)) + " tick tock" * 60_000
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(
        "runs", F.length("collapsed").alias("size")
    ).first()
    assert [tuple(run) for run in row.runs] == [(150_000, 120_000, 2)]
    assert row.size == len(re.sub(r"(?: tick tock)+$", " tick tock", text))
