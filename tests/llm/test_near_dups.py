import random

from kerbside.llm import near_dups
from kerbside.llm.near_dups import near_duplicates, without_duplicates
from tests.llm.helpers import MIDDLE, documents, near_groups


def found(df):
    return {row.doc_id: (row.n_shingles, row.component_id) for row in near_duplicates(df).collect()}


def test_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    assert found(docs) == near_groups([(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()])


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_group_that_straddles_the_threshold(spark, monkeypatch):
    """Many members around 0.75, so that components hang on single links, and small blocks."""
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    rng = random.Random(7)
    base = [f"v{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(at, edited(rng, base, rng.randrange(1, 9)), "s") for at in range(150)]
    # A passage that makes a third of each of many documents must link none of them.
    rows += [(1000 + at, " ".join(base[:50]) + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(100)), "s") for at in range(40)]
    got = found(documents(spark, rows))
    want = near_groups([(doc_id, text) for doc_id, text, _ in rows])
    assert len({component for _, component in want.values()}) > 41
    assert got == want


def test_edges(spark):
    long = " ".join(f"x{at}" for at in range(30_000))
    rows = [
        (5, "a b c", "s"),
        (3, "A  B\nC", "s"),
        (9, "", None),
        (8, None, "s"),
        (7, " \t\n", "s"),
        (6, "a b c d", "s"),
        (11, long, "s"),
        (10, long + " y", "s"),
        (4, "É f g h i j", "s"),
        (2, "é f g h i j", "s"),
        (None, "a b c", "s"),
        (12, "a b c d", "s"),
        (12, "a b c d", "s"),
    ]
    out = near_duplicates(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    got = {row.doc_id: (row.n_shingles, row.component_id, row.kept) for row in out}
    assert got[5] == (1, 3, False) and got[3] == (1, 3, True)
    assert got[9] == (0, 9, True) and got[8] == (0, 8, True) and got[7] == (0, 7, True)
    assert got[12] == (1, 6, False) and got[6] == (1, 6, True)
    assert got[11][1:] == (10, False) and got[10][1:] == (10, True)
    assert got[4][1] == 4 and got[2][1] == 2
    assert got[None] == (1, None, True)
    kept = without_duplicates(documents(spark, rows))
    assert sorted(row.doc_id or -1 for row in kept.collect()) == [-1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert near_duplicates(documents(spark, [])).count() == 0
