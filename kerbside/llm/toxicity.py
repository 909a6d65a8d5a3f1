"""Toxicity of restored text: a character model of the whole corpus, a lexicon and a logistic fit.

1. Every text of the corpus is counted into runs of four characters (``deobfuscation``).
2. A bounded sample of labelled rows is restored; words and beginnings of words that toxic documents
   hold far more often than others become the lexicon.
3. A document's score is a logistic function of the weights of its words, fitted on the same sample
   with each document's own share taken out of the weights.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import limit_batches, pick, stored
from kerbside.llm.deobfuscation import Restorer, gram_counts, log_model, suspicious
from kerbside.llm.text_arrays import chunks

#: Most labelled rows that the classifier is fitted on: those with the smallest hash of the id.
TRAIN_ROWS = 20_000
#: Most entries of the lexicon, the strongest first.
LEXICON = 20_000
THRESHOLD = 0.3
#: A feature needs so many toxic documents, such a log odds ratio, and to be so unlikely by chance (as a
#: negative logarithm: rare words are many, and some meet toxic documents only by accident).
FEWEST, ODDS, SURPRISE = 3, 2.0, 10.0
#: A beginning of words that owes more than this share of its toxic documents to one word says nothing new.
ONE_WORD = 0.8
PREFIXES = (4, 5, 6)

_EDGES = ".,;:!?\"'()[]{}<>%*#$&|+=/\\-_~^`@…«»“”„’"


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def words_of(text: str) -> set[str]:
    return {word.strip(_EDGES) for word in set(text.lower().split())} - {""}


def features_of(word: str) -> list[str]:
    """The word, and its beginnings (marked by a star)."""
    return [word, *(word[:size] + "*" for size in PREFIXES if len(word) > size)]


def _restored(restorer: Restorer, texts: pa.Array) -> Iterator[str]:
    for first, end, data, offsets in chunks(texts):
        doubted = suspicious(data, offsets)
        for at, text in enumerate(texts.slice(first, end - first)):
            text = text.as_py() or ""
            yield restorer.restore(text) if doubted[at] else text


def _document_features(text: str) -> set[str]:
    return {feature for word in words_of(text) for feature in features_of(word)}


def _counted(model: np.ndarray, wanted: frozenset | None):
    """(feature, toxic, clean): documents of a task by label; all features of toxic rows, or wanted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), _restored(restorer, batch.column(1))):
                features = _document_features(text)
                (toxic if label else clean).update(features if wanted is None else features & wanted)
        names = list(toxic | clean)
        if names:
            numbers = [pa.array([of[name] for name in names], pa.int64()) for of in (toxic, clean)]
            columns = [pa.array(names), *numbers]
            yield pa.record_batch(columns, names=["feature", "toxic", "clean"])

    return run


@dataclass
class Model:
    """All that scoring needs; bounded by ``GRAMS`` and ``LEXICON``, whatever the size of the corpus."""

    grams: np.ndarray
    lexicon: dict[str, float]
    fit: np.ndarray  # constant, weight of all the evidence, weight of the strongest

    def __post_init__(self) -> None:
        #: How words begin that can have a weight; all others are passed over.
        self.heads = frozenset(feature.rstrip("*")[: PREFIXES[0]] for feature in self.lexicon)

    def evidence(self, text: str) -> tuple[float, float]:
        """Of all different words: the logarithm of the summed weights, and the largest weight."""
        found, most, heads, size = 0.0, 0.0, self.heads, PREFIXES[0]
        for word in [word for word in words_of(text) if word[:size] in heads]:
            weight = max(self.lexicon.get(feature, 0.0) for feature in features_of(word))
            found += weight
            most = max(most, weight)
        return np.log1p(found), most


def _weight(toxic, clean, n_toxic, n_clean):
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


def _surprise(toxic: int, clean: int, share: float) -> float:
    """Chernoff's bound on the chance that so many of the documents are toxic, as a negative logarithm."""
    n = toxic + clean
    part = toxic / n
    rest = (1 - part) * np.log((1 - part) / (1 - share)) if clean else 0.0
    return n * (part * np.log(part / share) + rest) if part > share else 0.0


def _evidence_rows(model: np.ndarray, counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int):
    """(label, evidence, strongest) of labelled rows, each against counts without itself."""

    def weights(label: int) -> dict[str, float]:
        less = (1, 0) if label else (0, 1)
        return {
            feature: max(0.0, float(_weight(max(toxic - less[0], 0), max(clean - less[1], 0), n_toxic, n_clean)))
            if toxic - less[0] >= FEWEST - 1
            else 0.0
            for feature, (toxic, clean) in counts.items()
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        by_label = [Model(model, weights(label), np.zeros(3)) for label in (0, 1)]
        for batch in batches:
            labels = batch.column(0).to_pylist()
            texts = _restored(restorer, batch.column(1))
            rows = [(label, *by_label[label].evidence(text)) for label, text in zip(labels, texts)]
            if rows:
                label, evidence, strongest = zip(*rows)
                columns = [pa.array(label, pa.int32()), pa.array(evidence, pa.float64()), pa.array(strongest, pa.float64())]
                yield pa.record_batch(columns, names=["label", "evidence", "strongest"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton's method; the penalty keeps separable data finite."""
    x = np.column_stack([np.ones(len(x)), x])
    fit = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -30, 30)))
        slope = x.T @ (y - p) - ridge * fit
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(fit))
        step = np.linalg.solve(curve, slope)
        fit += step
        if np.abs(step).max() < 1e-8:
            break
    return fit


def corpus_model(texts: DataFrame) -> np.ndarray:
    """The character model of all texts. Tasks count; at most 32^4 sums reach the driver."""
    counts = texts.select("text").mapInArrow(gram_counts, "gram long, n long")
    counts = counts.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    return log_model(counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.float64))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """``docs``: (doc_id, text); ``labels``: (doc_id, toxic). Held-out rows teach nothing but characters."""
    spark = docs.sparkSession
    limit_batches(spark)
    grams = corpus_model(docs)
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = docs.join(F.broadcast(sample), "doc_id").where("text is not null")
    # Copies would make their rare words look telling: every text teaches once.
    rows = rows.groupBy(F.xxhash64("text").alias("body")).agg(F.max("label").alias("label"), F.first("text").alias("text"))
    rows = stored(rows.select(F.col("label").cast("int"), "text"), "taught")
    sizes = dict(rows.groupBy("label").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        rate = 1.0 if n_toxic else 0.0
        return Model(grams, {}, np.array([20.0 * (2 * rate - 1), 0.0, 0.0]))
    schema = "feature string, toxic long, clean long"
    held = spark.sparkContext.broadcast(grams)
    toxic = rows.where("label = 1").mapInArrow(lambda b: _counted(held.value, None)(b), schema)
    toxic = toxic.groupBy("feature").agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= FEWEST)
    # Rarest word forms last; the bound holds whatever the sample.
    wanted = toxic.orderBy(F.col("toxic").desc(), "feature").limit(10 * LEXICON).collect()
    counts = {row["feature"]: [row["toxic"], 0] for row in wanted}
    asked = spark.sparkContext.broadcast(frozenset(counts))
    clean = rows.where("label = 0").mapInArrow(lambda b: _counted(held.value, asked.value)(b), schema)
    for row in clean.groupBy("feature").agg(F.sum("clean").alias("clean")).collect():
        counts[row["feature"]][1] = row["clean"]
    share, chosen = n_toxic / (n_toxic + n_clean), {}
    leading = Counter()
    for word, (t, _) in counts.items():
        for start in features_of(word)[1:] if not word.endswith("*") else ():
            leading[start] = max(leading[start], t)
    for feature, (t, c) in counts.items():
        if leading[feature] > ONE_WORD * t:
            continue
        weight = float(_weight(t, c, n_toxic, n_clean))
        if weight >= ODDS and _surprise(t, c, share) >= SURPRISE:
            chosen[feature] = (weight, t, c)
    best = sorted(chosen, key=lambda feature: (-chosen[feature][0], feature))[:LEXICON]
    kept = spark.sparkContext.broadcast({feature: chosen[feature][1:] for feature in best})
    found = rows.mapInArrow(
        lambda b: _evidence_rows(held.value, kept.value, n_toxic, n_clean)(b), "label int, evidence double, strongest double"
    ).toPandas()
    fit = _logistic(found[["evidence", "strongest"]].to_numpy(), found["label"].to_numpy(np.float64))
    return Model(grams, {feature: chosen[feature][0] for feature in best}, fit)


def _scores(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        restorer = Restorer(model.grams)
        for batch in batches:
            x = np.array([(1.0, *model.evidence(text)) for text in _restored(restorer, batch.column(1))]).reshape(-1, 3)
            score = 1 / (1 + np.exp(-np.clip(x @ model.fit, -30, 30)))
            yield pa.record_batch([batch.column(0), pa.array(score)], names=["at", "score"])

    return run


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    ``score`` (0 to 1) looks at the restored text alone. The classifier learns from at most
    ``train_rows`` labelled rows that are not held out; labels of one id are united (toxic wins). If
    the sample has one class only, every score is that class's.

    Null and empty texts are scored as texts without words. Null labels and null ids teach nothing; a
    null id is not held out. Rows that repeat an id or a text are scored alike. Texts are read whole.
    An empty table gives no rows. Other columns are not looked at.
    """
    docs = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text")
    labels = pick(labels, doc_id="doc_id", toxic=label)
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, train_rows))
    scored = docs.mapInArrow(_scores(held), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) whose text is not predicted toxic."""
    names = docs.columns
    at = names.index("text")
    held = docs.sparkSession.sparkContext.broadcast(
        train(pick(docs, doc_id="doc_id", text="text"), pick(labels, doc_id="doc_id", toxic="toxic"))
    )
    rows = docs.toDF(*(f"_{place}" for place in range(len(names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        restorer = Restorer(model.grams)
        for batch in batches:
            x = np.array([(1.0, *model.evidence(text)) for text in _restored(restorer, batch.column(at))]).reshape(-1, 3)
            score = 1 / (1 + np.exp(-np.clip(x @ model.fit, -30, 30)))
            yield batch.filter(pa.array(score < threshold))

    return rows.mapInArrow(run, rows.schema).toDF(*names)
