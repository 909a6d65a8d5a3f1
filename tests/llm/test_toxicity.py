import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm.deobfuscation import GRAMS, Restorer, suspicious
from kerbside.llm.toxicity import corpus_model, held_out, score_toxicity, without_toxic
from tests.llm.helpers import MIDDLE, documents


@pytest.fixture(scope="module")
def restorer(spark):
    return Restorer(corpus_model(spark.read.parquet(f"{MIDDLE}/documents.parquet")))


@pytest.mark.parametrize(
    "written, meant",
    [
        ("that 1d10t there", "that idiot there"),
        ("an i d i o t here", "an idiot here"),
        ("an i.d.1.o.t here", "an idiot here"),
        ("such a m0r0n and l0$er", "such a moron and loser"),
        ("idiiiiiot", "idiot"),
        ("p4th3t1c", "pathetic"),
        ("s c u m", "scum"),
        ("w0rthless", "worthless"),
        ("w0rthle$$", "worthless"),
        ("iid10oott", "idiot"),
        ("an i--d - i__o..t here", "an idiot here"),
        ("an ii dd i oo t here", "an idiot here"),
    ],
)
def test_disguises(restorer, written, meant):
    assert restorer.restore(written) == meant


@pytest.mark.parametrize("written", ["sh17", "d13", "a55", "a$$", "fr33", "idi07", "f@990t", "an ii -- dd_.e"])
def test_stretches_reach_the_lattice(written):
    """Marks behind a word and long runs of marks are decoded, whatever the model then makes of them."""
    asked = []

    class Asked(Restorer):
        def decode(self, text):
            asked.append(text)
            return text

    Asked(np.full(GRAMS, -len(written), np.float32)).restore(written)
    assert asked == [written.removeprefix("an ")]


@pytest.mark.parametrize("text", ["The anat with by. Ores re threlyes", "12 345", "", "ééé", "a", "wh*** the### and%%%", "2024-01-02"])
def test_plain_text_stays(restorer, text):
    assert restorer.restore(text) == text


def test_doubt_is_never_too_rare(restorer):
    texts = ["plain words", "an 1d", "i d i o t", "heyyy", "a", "", "x y z w", "é0é", "loo", "k-o-x", "sh17", "a$$", "f@990t", "i--d - i__o", "ii dd oo", "x ii d y", "so a b"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(text.encode()) for text in texts)])
    doubted = suspicious(np.frombuffer(data, np.uint8), offsets)
    for text, flag in zip(texts, doubted):
        assert flag or restorer.restore(text) == text


def test_long_stretches_take_linear_time():
    """Twice as long, about twice as slow: nothing is tried again from every character of a run."""
    restorer = Restorer(np.zeros(GRAMS, np.float32))

    def seconds(text):
        restorer.known.clear()
        begun = time.perf_counter()
        restorer.restore(text)
        return time.perf_counter() - begun

    for part in ("abcdefghij", "!", "$", "a", "a ", "!.", "é", "=-", "a1", "aaab", ". "):
        least = min(seconds(part * (50_000 // len(part))) for _ in range(2))
        assert seconds(part * (200_000 // len(part))) < 12 * least + 0.2, part


def test_any_number_of_equal_letters_apart(restorer):
    assert restorer.restore("an " + "i" * 15 + " d i o t here") == "an idiot here"


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1.0
    ones = label == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    scored = score_toxicity(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").toPandas()
    right = rows[rows.predicted == 1].toxic.mean()
    found = rows[rows.toxic == 1].predicted.mean()
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.95 and right > 0.9 and found > 0.9


def test_edges(spark):
    bad, good = "you are an idiot and a moron", "the weather is fine and mild today"
    rows = [(at, f"{bad if at % 3 == 0 else good} number {chr(97 + at % 26)}{chr(97 + at // 26)}", "s") for at in range(300)]
    rows += [(1000, None, "s"), (1001, "", "s"), (1002, "an 1d10t and a m o r o n " + "word " * 50_000, "s"), (None, bad, "s"), (0, good, "s")]
    taught = spark.createDataFrame(
        [(at, int(at % 3 == 0)) for at in range(300)] + [(1, None), (None, 1), (2, 0), (5000, 1)], "doc_id long, toxic int"
    )
    labels = taught.selectExpr("*", "1 as TOXIC", "2 as label")
    table = documents(spark, rows)
    got = score_toxicity(table, labels).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    by_id = got.dropna(subset="doc_id").groupby("doc_id").predicted.max()
    assert by_id[3] == 1 and by_id[4] == 0 and by_id[1000] == 0 and by_id[1001] == 0
    kept = without_toxic(table, labels)
    assert kept.columns == table.columns
    ids = {row[0] for row in kept.collect()}
    assert 4 in ids and 3 not in ids and None not in ids and {1000, 1001} <= ids
    # One class, no label at all, no document.
    assert {row.predicted for row in score_toxicity(table, taught.where("toxic = 0")).collect()} == {0}
    assert {row.predicted for row in score_toxicity(table, labels.limit(0)).collect()} == {0}
    assert score_toxicity(documents(spark, []), labels).count() == 0


def test_held_out_rows_teach_nothing(spark):
    """Turning their labels round changes no score."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (score_toxicity(docs, taught).orderBy("doc_id").toPandas() for taught in (labels, turned))
    assert np.allclose(one.score, two.score, atol=1e-9)
