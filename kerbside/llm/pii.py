"""Personal data: wide generators propose, boosted trees judge, calibrated thresholds select.

Native. Four strict patterns with their checks give the base spans, which always stay. Wider patterns
propose more spans, which may overlap: addresses and numbers in other spellings. What is known of the
proposals labels some of them: a strict match that passes its check is personal data, one that fails it
is not, nor is a proposal that lies across a base span of another kind. Gradient-boosted trees learn from
format and context which is which; held-out labelled proposals give each kind the lowest threshold with
the wanted precision; of overlapping proposals above it the best one is selected.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import pick, stored
from kerbside.llm.spans import bound, matches

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns of the base spans, in a form that never goes back: a run of characters is taken whole, and
# a start within a run is not tried (it could not do better), unless the match before ended there.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+(?<=[0-9][\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

_AT = r"(?:@|\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?|\x20(?i:at)\x20)"
_DOT = r"(?:\.|\x20?[\[({]\x20?(?i:dot|punkt|point|punto)\x20?[\])}]\x20?|\x20(?i:dot)\x20)"
_IP_DOT = r"(?:\.|\[\.\]|\(\.\)|\x20?[\[({](?i:dot)[\])}]\x20?)"
#: Wide patterns; each kind may have several, and their matches may overlap those of others.
WIDE = (
    ("email", rf"(?<![\p{{L}}\p{{N}}._%+'-])[\p{{L}}\p{{N}}._%+'-]{{1,64}}+{_AT}[\p{{L}}\p{{N}}-]{{1,63}}+(?:{_DOT}[\p{{L}}\p{{N}}-]{{1,63}}+){{1,5}}+"),
    ("phone", r"(?<![\p{L}0-9.+])(?:\+|00)?(?:\x20?\(?[0-9]{1,5}\)?[\x20./-]{0,2}){2,7}(?<=[0-9])(?![\p{L}0-9])"),
    ("card", r"(?<![\p{L}0-9.+-])[0-9]{4}([\x20./-]{0,2})[0-9]{4,6}\1[0-9]{4,5}(?:\1[0-9]{1,7})?(?![\p{L}0-9])"),
    ("ip", rf"(?<![\p{{L}}0-9.])[0-9]{{1,3}}(?:{_IP_DOT}[0-9]{{1,3}}){{3}}(?![\p{{L}}0-9])"),
    ("ip", r"(?<![\p{L}0-9:.])(?:[0-9A-Fa-f]{1,4}::?){2,7}[0-9A-Fa-f]{1,4}(?![\p{L}0-9:])"),
)
# Fixed words that announce a kind, in the languages of the corpus.
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|mailto|contact|kontakt|contacto|correo|courriel|adresse)\b",
    "ip": r"(?i)\b(?:ip|ipv4|ipv6|host|server|servidor|serveur|addr|address)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|karte|kreditkarte|carte|tarjeta|iban|konto)\b",
    "phone": r"(?i)\b(?:phone|tel|telefon|t[eé]l[eé]phone|tel[eé]fono|call|mobile|mobil|handy|fax|m[oó]vil|anruf|appelez|whatsapp)\b",
}
#: Characters of the text before and after a proposal that its features look at.
BEFORE, AFTER = 32, 4

#: Labelled proposals of each class that the trees are fitted on, at most: those with the smallest hashes.
SAMPLE = 5_000
TREES, DEPTH, STEP = 20, 4, 0.3
#: Held-out proposals above a kind's threshold must be personal data with this precision, and so many at least.
PRECISION, SUPPORT, BINS = 0.95, 10, 50

FEATURES = (
    *(f"is_{kind}" for kind in KINDS),
    "size", "digits", "letters", "groups", "longest", "last", "dots", "colons", "signs",
    "mark", "luhn", "fits", "top_level", "cue", "other_cue", "glued", "line_start",
)

_CANDIDATE = "struct<start:int,end:int,rank:int,strict:boolean,valid:boolean,features:array<double>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the check: from the right, every second one counts twice, less 9 above 9."""
    one = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda at: F.substring(digits, at, F.lit(1)).cast("int"))
    twice = F.transform(
        F.reverse(one), lambda d, at: F.when(at % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(twice, F.lit(0), lambda total, d: total + d) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The check of a strict match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    count = F.length(_digits(value))
    if kind == "phone":
        return count.between(*PHONE_DIGITS)
    return bound(_digits(value), lambda d: F.when(F.length(d).between(*CARD_DIGITS), luhn(d)).otherwise(F.lit(False)))


def _features(kind: str, value: Column, before: Column, after: Column) -> Column:
    """Format of the plain spelling, and what stands around the proposal; one number each of ``FEATURES``."""

    def number(column: Column) -> Column:
        return column.cast("double")

    def count(column: Column, characters: str) -> Column:
        return F.length(column) - F.length(F.regexp_replace(column, characters, ""))

    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(value, _AT, "@"), _DOT, ".")
        mark = value.contains("@")
    elif kind == "ip":
        plain = F.regexp_replace(value, _IP_DOT, ".")
        mark = F.length(plain) == F.length(value)
    elif kind == "phone":
        plain = F.regexp_replace(value, r"^(?:\+|00)", "")
        mark = value.startswith("+")
    else:
        plain, mark = value, value.rlike(r"^[0-9]++(?:[\x20-][0-9]++)*+$")
    near = F.right(before, F.lit(BEFORE))
    cues = {name: near.rlike(pattern) for name, pattern in CUES.items()}
    others = [cue for name, cue in cues.items() if name != kind]

    def listed(plain: Column) -> Column:
        groups = F.filter(F.split(plain, "[^0-9]+"), lambda group: group != "")
        digits = _digits(plain)
        fits = {
            "email": plain.rlike(r"^[^@]++@[^@.]++(?:\.[^@.]++)++$"),
            "ip": plain.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$") | plain.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$"),
            "card": F.length(digits).between(13, 19),
            "phone": F.length(digits).between(9, 15),
        }[kind]
        checked = F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False)) if kind == "card" else F.lit(False)
        return F.array(
            *(F.lit(float(kind == one)) for one in KINDS),
            number(F.length(plain)),
            number(F.length(digits)),
            number(count(plain, r"\p{L}")),
            number(F.size(groups)),
            number(F.coalesce(F.array_max(F.transform(groups, lambda group: F.length(group))), F.lit(0))),
            number(F.coalesce(F.length(F.try_element_at(groups, F.lit(-1))), F.lit(0))),
            number(count(plain, r"\.")),
            number(count(plain, ":")),
            number(count(plain, r"[\x20()/-]")),
            number(mark),
            number(checked),
            number(fits),
            number(F.length(F.regexp_extract(plain, r"\.(\p{L}+)$", 1))),
            number(cues[kind]),
            number(others[0] | others[1] | others[2]),
            number(before.rlike(r"[\p{L}\p{N}@_=]$") | after.rlike(r"^[\p{L}\p{N}@_]")),
            number((before == "") | before.rlike(r"\n\s*$")),
        )

    return bound(plain, listed)


def _proposals(text: Column, kind: str, pattern: str, strict: bool) -> Column:
    def entry(start: Column, end: Column, value: Column, before: Column, after: Column) -> Column:
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(strict).alias("strict"),
            (passes(kind, value) if strict else F.lit(False)).alias("valid"),
            _features(kind, value, F.right(before, F.lit(BEFORE)), F.left(after, F.lit(AFTER))).alias("features"),
        )

    return matches(text, pattern, entry).cast(f"array<{_CANDIDATE}>")


def spelled(spans: Column) -> Column:
    """kind:start:end of each (start, rank, end), by start and then kind, joined by commas."""
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ","
    )


def _judged_overlaps(proposals: DataFrame) -> DataFrame:
    """Beside each proposal: whether a base span of its text overlaps it, and whether one of another kind does."""
    limits = (Window.unboundedPreceding, -1)
    forth = Window.partitionBy("uid").orderBy("start", F.col("valid").desc(), "end", "rank").rowsBetween(*limits)
    back = Window.partitionBy("uid").orderBy(F.col("start").desc(), "valid", "end", "rank").rowsBetween(*limits)
    ahead = F.max(F.when(F.col("valid"), F.struct("end", "rank"))).over(forth)
    behind = F.min(F.when(F.col("valid"), F.struct("start", "rank"))).over(back)
    proposals = proposals.withColumn("ahead", ahead).withColumn("behind", behind)
    first = F.coalesce(F.col("ahead.end") > F.col("start"), F.lit(False))
    second = F.coalesce(F.col("behind.start") < F.col("end"), F.lit(False))
    return proposals.select(
        *(name for name in proposals.columns if name not in ("ahead", "behind")),
        (first | second).alias("crossed"),
        ((first & (F.col("ahead.rank") != F.col("rank"))) | (second & (F.col("behind.rank") != F.col("rank")))).alias("alien"),
    )


def _vectors(rows: DataFrame) -> DataFrame:
    named = rows.withColumns({name: F.get("features", F.lit(at)) for at, name in enumerate(FEATURES)})
    return VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(named).drop(*FEATURES)


def _fit(labelled: DataFrame, sample: int):
    """The trees, or None if one class is missing. The sample is sorted into one task, so every fit is the same."""
    order = ["hash", "doc_id", "start", "end", "rank"]
    parts = [labelled.where(F.col("label") == label).orderBy(*order).limit(sample) for label in (1.0, 0.0)]
    chosen = stored(parts[0].unionByName(parts[1]).select(*order, "features", "label"), "pii-sample")
    counts = {row.label: row["count"] for row in chosen.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    # Each positive is learnt twice, as it is and without its tell-tale mark, so that other spellings are not ruled out.
    mark = FEATURES.index("mark")
    without = F.transform("features", lambda x, at: F.when(at == mark, 0.0).otherwise(x))
    both = F.when(F.col("label") == 1, F.array(F.col("features"), without)).otherwise(F.array(F.col("features")))
    learnt = chosen.withColumn("features", F.explode(both)).withColumn(
        "weight", F.col("label") / (2 * counts[1.0]) + (1 - F.col("label")) / counts[0.0]
    )
    learnt = _vectors(learnt.coalesce(1).sortWithinPartitions(*order, F.get("features", F.lit(mark))))
    return GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7
    ).fit(learnt)


def _scored(model, rows: DataFrame) -> DataFrame:
    model = model.setProbabilityCol("probability").setRawPredictionCol("raw").setPredictionCol("guess")
    out = model.transform(_vectors(rows))
    return out.withColumn("score", vector_to_array("probability")[1]).drop("vector", "probability", "raw", "guess")


def _thresholds(held_out: DataFrame, precision: float) -> dict[int, float]:
    """For each kind the lowest bin from which on scores have the wanted precision, both classes weighing alike.

    Counts per kind and bin are all that reaches the driver. A kind without enough examples gets none.
    """
    bins = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin")
    counts = held_out.groupBy("rank", bins).agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    out = {}
    for rank in range(len(KINDS)):
        good, n = [0.0] * BINS, [0] * BINS
        for row in counts:
            if row.rank == rank:
                good[row.bin], n[row.bin] = row.good, row.n
        for bin_ in range(BINS):
            if sum(good[bin_:]) >= SUPPORT and sum(good[bin_:]) >= precision * (sum(n[bin_:]) + 0.5):
                out[rank] = bin_ / BINS
                break
    return out


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    precision: float = PRECISION,
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_added, base, spans), one row per row.

    ``base``: the strict matches that pass their checks, as (start, rank, end) with rank the place in
    ``KINDS``; the counts are theirs. ``spans``: these and the ``n_added`` selected proposals. An added span
    overlaps no base span; of added spans that overlap (directly or through others) the one with the highest
    score stays, of equal ones the first, then the longest. A kind adds nothing while the corpus has too few
    labelled examples of it; with no example, or no counterexample, of any kind nothing is added.

    A null text counts as empty and has no spans. Texts are read whole. Repeated rows are rows of their own
    with equal spans; a null id stays null. An empty table gives no rows. Other columns are not looked at.
    The trees are fitted on at most ``sample`` proposals of either class; thresholds use all held-out ones.
    """
    docs = pick(docs, doc_id=doc_id, text=text).select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    strict = {kind: _proposals(F.col("text"), kind, pattern, True) for kind, pattern in STRICT.items()}
    wide = {f"wide_{at}": _proposals(F.col("text"), kind, pattern, False) for at, (kind, pattern) in enumerate(WIDE)}
    strict["email"] = F.when(F.col("text").contains("@"), strict["email"]).otherwise(F.array().cast(f"array<{_CANDIDATE}>"))
    found = docs.withColumns(strict | wide).select("uid", "doc_id", F.concat(*strict, *wide).alias("proposals"))
    found = stored(found, "pii-proposals")
    proposals = found.where(F.size("proposals") > 0).select("uid", "doc_id", F.inline("proposals"))
    proposals = stored(_judged_overlaps(proposals), "pii-overlaps")
    label = F.when(F.col("valid"), 1.0).when(F.col("strict") | F.col("alien"), 0.0)
    digest = F.xxhash64("doc_id", "start", "end", "rank")
    held_out = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(4)) == 0
    labelled = proposals.withColumns({"label": label, "hash": digest, "held_out": held_out}).where("label is not null")
    model = _fit(labelled.where(~F.col("held_out")), sample)
    base = F.transform(
        F.filter("proposals", lambda p: p["valid"]), lambda p: F.struct(p["start"], p["rank"], p["end"])
    )
    found = found.select("uid", "doc_id", base.cast("array<struct<start:int,rank:int,end:int>>").alias("base"))
    if model:
        limits = _thresholds(_scored(model, labelled.where("held_out")), precision)
        limit = F.lit(2.0)
        for rank, value in limits.items():
            limit = F.when(F.col("rank") == rank, value).otherwise(limit)
        others = proposals.where("not valid and not strict and not crossed")
        chosen = _best_apart(_scored(model, others).where(F.col("score") >= limit))
        added = chosen.groupBy("uid").agg(F.collect_list(F.struct("start", "rank", "end")).alias("added"))
        found = found.join(stored(added, "pii-added"), "uid", "left")
    else:
        found = found.withColumn("added", F.lit(None).cast("array<struct<start:int,rank:int,end:int>>"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return found.select(
        "doc_id",
        *(
            F.size(F.array_remove(F.transform("base", lambda s: s["rank"] == rank), False)).cast("long").alias(f"n_{kind}")
            for rank, kind in enumerate(KINDS)
        ),
        F.size(F.coalesce("added", none)).cast("long").alias("n_added"),
        "base",
        F.concat("base", F.coalesce("added", none)).alias("spans"),
    )


def _best_apart(accepted: DataFrame) -> DataFrame:
    """One of each group of proposals that overlap, directly or through others."""
    before = Window.partitionBy("uid").orderBy("start", "end", "rank")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    apart = accepted.withColumn("first", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
    islands = apart.withColumn("island", F.sum("first").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max_by(
        F.struct("start", "rank", "end"), F.struct("score", (-F.col("start")).alias("at"), "end", (-F.col("rank")).alias("kind"))
    )
    return islands.groupBy("uid", "island").agg(best.alias("best")).select("uid", "best.*")
