"""Benchmark decontamination on templates: numbers, units and names become typed placeholders.

Native. A question that was asked again with other numbers, names or units has the same template, so
windows of the templates are joined by hash; then the values that fill the same slot must agree all
through an occurrence in the document, so that a chance meeting of common phrases does not count as a copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import pick, small, stored
from kerbside.llm.spans import bound

WINDOW = 5
#: Share of an item's windows that a document must hold.
COVERED = 0.75
#: A window with fewer plain words than this says too little and is not used; an item without others counts as a whole.
PLAIN = 3

NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
#: Units are known after a number only.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb ml l s sec min h hr kb mb gb tb w kw hz khz mhz v a "
    "seconds minutes hours days weeks months years meters metres kilometers kilometres miles feet inches "
    "grams kilograms pounds ounces liters litres gallons dollars euros cents percent degrees"
)
_UNIT = "|".join(sorted(UNITS.split(), key=lambda unit: -len(unit)))
# Each pattern begins with the rarest character it can, as it is tried at every place of every text.
_NAME_MARK, _JOINT = "\x01", "\x02"
#: A unit that may be glued to its number.
_UNIT_AFTER = rf"(?i)(\d)\s*({_UNIT})(?![\p{{L}}\p{{N}}])"
#: A capitalised word after a word, comma, semicolon, colon, bracket or quote: it begins no sentence. "A" and "I" are none.
_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;:)\"'] \p{Lu})(?!(?<=[AI])(?![\p{L}'’-]))[\p{L}'’-]*"
#: A blank between two names: the run is one name.
_BETWEEN = rf"\x20{_NAME_MARK}(?<={_NAME_MARK}[\p{{L}}'’-]{{1,40}}\x20{_NAME_MARK})"
#: The common characters come first, as they are tried in this order.
_MARK = rf"[^a-z\x20A-Z\p{{L}}\p{{N}}\s{_NAME_MARK}{_JOINT}]"
#: A run of marks behind a blank, or the whole of one before a blank; each run is looked at once.
_EDGE = rf"{_MARK}(?:(?<!\S{_MARK}){_MARK}*+|(?<!{_MARK}{{2}}){_MARK}*+(?!\S))"
_NAMED = rf"{_NAME_MARK}\S+"
_NUMBERS = r"\d(?<!\S\d)\d*(?:[.,:/]\d+)*(?!\S)"
_UNITS = rf"(?i){NUMBER}(\s+)({_UNIT})(?!\S)"
#: White space other than one blank.
_RAGGED = r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++"


def _without(text: Column, *characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _where(texts: DataFrame, name: str, condition: Column, changed: Column) -> DataFrame:
    """The column changed where the condition holds. A step of its own, so that its input is computed once."""
    return texts.withColumn(name, F.when(condition, changed).otherwise(F.col(name)))


def _bare(texts: DataFrame) -> DataFrame:
    """``bare``: words without the marks around them; a name has a control character in front and others inside a run
    of names. Patterns for numbers and names are tried only where a digit or a name is."""
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = texts.select("id", F.regexp_replace(_without(text, _NAME_MARK, _JOINT), _RAGGED, " ").alias("bare"))
    bare = F.col("bare")
    texts = _where(texts, "bare", bare.rlike(r"\d"), F.regexp_replace(bare, _UNIT_AFTER, "$1 $2"))
    texts = texts.withColumn("bare", F.regexp_replace(bare, _NAME, _NAME_MARK + "$0"))
    texts = _where(texts, "bare", bare.contains(_NAME_MARK), F.regexp_replace(bare, _BETWEEN, _JOINT))
    return texts.withColumn("bare", F.regexp_replace(bare, _EDGE, ""))


def _plain(bare: Column) -> Column:
    """Names as the words they are."""
    return _without(F.replace(bare, F.lit(_JOINT), F.lit(" ")), _NAME_MARK)


def _units(texts: DataFrame, name: str) -> DataFrame:
    """The column with units after numbers as placeholders, in lower case."""
    texts = _where(texts, name, F.col(name).contains(NUMBER), F.regexp_replace(name, _UNITS, f"{NUMBER}$1{UNIT}"))
    return texts.withColumn(name, F.lower(name))


def _words(text: Column) -> Column:
    """Of a text whose white space is blanks."""
    return F.array_remove(F.split(text, " "), "")


def _starts(words: Column) -> Column:
    """0 to the last place a window can start at; no place for fewer words than a window."""
    last = F.size(words) - F.lit(WINDOW)
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _hash(words: Column) -> Column:
    """The hash of a window, or of any other run of words: a hash of the words' hashes."""
    return F.xxhash64(_word_hashes(words))


def _hashes(words: Column, length: int = WINDOW) -> Column:
    """``_hash`` of every run of so many words, in order; each word is hashed once."""

    def runs(hashes: Column) -> Column:
        last = F.size(hashes) - F.lit(length)
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        if length > WINDOW:
            return F.transform(starts, lambda at: F.xxhash64(F.slice(hashes, at + 1, length)))
        return F.transform(starts, lambda at: F.xxhash64(*(F.get(hashes, at + more) for more in range(length))))

    return bound(_word_hashes(words), runs)


def _templated(texts: DataFrame) -> DataFrame:
    """(id, named, words, values, folded, spoken, masked): the template's words and, place for place, what they stand
    for; the same with names as words like others, in lower case, for texts whose case tells no names; and ``folded``
    with a placeholder for each word of a name. Without names (``named``) all readings are one."""
    bare = F.col("bare")
    texts = _bare(texts.select("id", "text")).withColumn("named", bare.contains(_NAME_MARK))
    texts = texts.withColumn("words", bare)
    texts = _where(texts, "words", bare.rlike(r"\d"), F.regexp_replace(bare, _NUMBERS, NUMBER))
    named, numbered = F.col("named"), F.col("words")
    apart = F.replace(numbered, F.lit(_JOINT), F.lit(" " + _NAME_MARK))
    texts = texts.select(
        "id", "named", "bare",
        F.when(named, _plain(numbered)).alias("folded"),
        F.when(named, F.regexp_replace(apart, _NAMED, NAME)).alias("masked"),
        F.when(named, F.regexp_replace(numbered, _NAMED, NAME)).otherwise(numbered).alias("words"),
    )
    for name in ("words", "folded", "masked"):
        texts = _units(texts, name)
    texts = texts.select(
        "id", "named",
        *(_words(F.col(name)).alias(name) for name in ("words", "folded", "masked")),
        _words(F.lower(_without(bare, _NAME_MARK))).alias("values"),
        F.when(named, _words(F.lower(_plain(bare)))).alias("spoken"),
    )
    others = (F.coalesce(name, same).alias(name) for name, same in (("folded", "words"), ("spoken", "values"), ("masked", "words")))
    return texts.select("id", "named", "words", "values", *others)


#: How a window is read: with names typed; with names as words; with the item's names open in a document whose case
#: tells no names; or as the whole word sequence of an item.
TYPED, FOLDED, MASKED, WHOLE = 0, 1, 2, 3
_OF_ITEMS = ((TYPED, "words", "values"), (FOLDED, "folded", "spoken"), (MASKED, "masked", "spoken"))
_OF_DOCUMENTS = ((TYPED, "words", "values"), (FOLDED, "folded", "spoken"), (MASKED, "folded", "spoken"))


def _read(templated: DataFrame, readings: tuple) -> DataFrame:
    """A row of (kind, words, values) for each reading."""
    kinds = F.array(*(
        F.struct(F.lit(kind).alias("kind"), F.col(words).alias("words"), F.col(values).alias("values"))
        for kind, words, values in readings
    ))
    return templated.select("id", F.explode(kinds).alias("as")).select("id", "as.*")


def _item_windows(items: DataFrame) -> DataFrame:
    """(item_id, kind, place, hash, window, asked): windows with enough plain words; of items without any, all the words."""
    templated = stored(_templated(items.select(F.col("item_id").alias("id"), "text")), "items")
    rows = _read(templated, _OF_ITEMS).where((F.col("kind") != MASKED) | F.array_contains("words", NAME))
    rows = rows.select("*", F.explode(_starts(F.col("words"))).alias("place"))
    window = F.slice("words", F.col("place") + 1, WINDOW)
    plain = F.size(F.filter(window, lambda word: ~word.isin(NUMBER, UNIT, NAME)))
    asked = F.slice("values", F.col("place") + 1, WINDOW)
    kept = rows.where(plain >= PLAIN).select(
        F.col("id").alias("item_id"), "kind", "place", _hash(window).alias("hash"), window.alias("window"), asked.alias("asked")
    )
    kept = stored(kept, "usable")
    short = templated.join(kept.select(F.col("item_id").alias("id")).distinct(), "id", "left_anti").where(F.size("spoken") > 0)
    whole = short.select(
        F.col("id").alias("item_id"), F.lit(WHOLE).alias("kind"), F.lit(0).alias("place"), _hash(F.col("spoken")).alias("hash"),
        F.col("spoken").alias("window"), F.col("spoken").alias("asked"),
    )
    return kept.unionByName(whole)


def _open(kind: Column, window: Column) -> Column:
    """Whether a window of an item has names that may be any word of the document."""
    return (kind == MASKED) & F.array_contains(window, NAME)


def _opened(met: DataFrame, rows: DataFrame, usable: DataFrame) -> DataFrame:
    """Windows with open names, looked for where the item's other windows say that they must be."""
    offsets = met.select("id", "item_id", "body", "windows", (F.col("at") - F.col("place")).alias("far")).distinct()
    opened = usable.where(_open(F.col("kind"), F.col("window"))).drop("kind")
    due = offsets.join(small(opened, 100_000), "item_id").withColumn("at", F.col("place") + F.col("far"))
    there = rows.where(F.col("kind") == MASKED).select("id", "body", "at", F.col("window").alias("seen"), "kind", "given")
    there = due.join(there, ["id", "body", "at"])
    return there.where(F.forall(F.zip_with("window", "seen", lambda w, s: (w == NAME) | (w == s)), lambda same: same))


def _whole(held: DataFrame, index: DataFrame) -> DataFrame:
    """(id, item_id, windows, matched): documents that hold all the words of an item without windows, word for word."""
    asked = index.where(F.col("kind") == WHOLE).select("item_id", "hash").distinct()
    one = F.lit(1).cast("long")
    found = held.join(small(asked), "hash").select("id", "item_id").distinct()
    return found.select("id", "item_id", one.alias("windows"), one.alias("matched"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, windows, matched, coverage): documents that hold a benchmark item.

    A document leaks an item if it holds at least ``COVERED`` of the item's windows (5 words of the
    template each) in one occurrence, with consistent slots: there, a number or unit at one place of the
    item, or a name wherever it stands, means one value of the document, the most frequent (of equals the
    smallest), and windows that say otherwise do not count. The best occurrence counts.

    Texts are also read with names as words like others, in lower case: a copy whose case tells no names is
    found by its own words, and one with other names as well if the windows between the item's names lie where
    they must and make up for it (an item with names in all windows is not found so); the better reading counts. An item without usable windows (fewer than 5 words, or
    hardly any plain ones) is found where all its words stand in a row, as one window. Null or empty texts
    leak nothing and are never found. Rows with a null doc_id or item_id take no part. Rows that
    repeat a doc_id are one document (an occurrence lies in one row), rows that repeat an item_id one item. Texts are taken whole.
    Empty tables give no rows. Other columns are not looked at.
    """
    docs = pick(docs, doc_id=doc_id, text=text).where("doc_id is not null")
    items = pick(benchmark, item_id=item_id, text=item_text).where("item_id is not null")
    index = stored(_item_windows(items), "item-windows")
    usable = index.where(F.col("kind") != WHOLE)
    whole = index.where(F.col("kind") == WHOLE).select(F.size("window")).distinct()
    lengths = sorted(row[0] for row in whole.collect())
    # First only numbers travel: which documents hold which windows, or whole short items. Each text is read once.
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    either = F.array_distinct(_hashes(F.col("words")))
    either = F.when(F.col("named"), F.array_union(either, _hashes(F.col("folded")))).otherwise(either)
    if lengths:
        either = F.concat(either, *(_hashes(F.col("spoken"), length) for length in lengths))
    hashes = _templated(texts).select("id", F.explode(either).alias("hash"))
    held = stored(hashes.join(small(index.select("hash").distinct()), "hash", "left_semi").distinct(), "held")
    heads = usable.select("item_id", "kind", "hash", _open(F.col("kind"), F.col("window")).alias("open")).distinct()
    sizes = heads.groupBy("item_id", "kind").agg(
        F.count(F.lit(1)).alias("windows"), F.count(F.when(F.col("open"), 1)).alias("n_open")
    )
    # Windows with open names are not looked up; the others must be so many that those can make up for the rest.
    need = F.greatest(F.lit(1), F.col("windows") * COVERED - F.col("n_open"))
    heads = heads.where("not open").join(sizes.select("item_id", "kind", "windows", need.alias("need")), ["item_id", "kind"])
    near = held.join(small(heads), "hash").groupBy("id", "item_id", "kind", "windows", "need").agg(F.count(F.lit(1)).alias("n"))
    near = stored(near.where("n >= need").select("id", "item_id", "kind", "windows"), "near")
    # Then the words of those documents, to see what fills the slots.
    texts = texts.join(small(near.select("id").distinct()), "id", "left_semi")
    texts = texts.select(F.struct("id", F.xxhash64("text").alias("body")).alias("id"), "text")
    open_names = not near.where(F.col("kind") == MASKED).isEmpty()
    rows = _read(_templated(texts), _OF_DOCUMENTS if open_names else _OF_DOCUMENTS[:2]).select("id.*", "kind", "words", "values")
    rows = rows.join(small(near.select("id", "kind").distinct()), ["id", "kind"], "left_semi")
    windows = F.transform(
        _hashes(F.col("words")),
        lambda h, at: F.struct(
            h.alias("hash"),
            F.slice("words", at + 1, WINDOW).alias("window"),
            F.slice("values", at + 1, WINDOW).alias("given"),
            at.alias("at"),
        ),
    )
    rows = rows.select("id", "body", "kind", F.inline(windows))
    matched = rows.join(small(usable.select("hash").distinct()), "hash", "left_semi")
    if open_names:
        matched = matched.where(F.col("kind") != MASKED).unionByName(rows.where(F.col("kind") == MASKED))
    rows = stored(matched, "rows")
    met = rows.join(near, ["id", "kind"]).join(small(usable, 100_000), ["item_id", "kind", "hash", "window"])
    columns = ["id", "item_id", "kind", "windows", "hash", "window", "asked", "given", "place", "at", "body"]
    met = stored(met.select(*columns).distinct(), "met")
    if open_names:
        met = met.unionByName(_opened(met.where(F.col("kind") == MASKED), rows, usable).select(*columns))
    best = _covered(stored(met.distinct(), "met-all"))
    if lengths:
        best = best.unionByName(_whole(held, index))
    return best.select(
        F.col("id").alias("doc_id"), "item_id", "windows", "matched", (F.col("matched") / F.col("windows")).alias("coverage")
    )


def _occurrences(met: DataFrame) -> DataFrame:
    """``met`` by occurrence: windows that lie equally far from their place in the item, and, as words may have
    been put in or left out, spans of distances of up to half the item's length, each overlapping the next by half."""
    far = F.col("at") - F.col("place")
    span = F.floor(far / F.greatest(F.lit(1), F.floor(F.col("windows") / 4)))
    keys = F.array(F.struct("body", "kind", F.lit(0).alias("k"), far.cast("long").alias("o")), *(
        F.struct("body", "kind", F.lit(1).alias("k"), (span + more).cast("long").alias("o")) for more in (0, 1)
    ))
    return met.withColumn("found", F.explode(keys))


def _covered(met: DataFrame) -> DataFrame:
    """Coverage by the windows whose slots agree with the bindings of their occurrence; the best occurrence counts.

    A number or unit is bound by its place in the item, a name by the name: it is one person all through.
    """
    met = _occurrences(met)
    zipped = F.arrays_zip("window", F.col("asked").alias("a"), F.col("given").alias("g"))
    slots = met.select("id", "item_id", "found", "place", "at", F.posexplode(zipped).alias("pos", "slot"))
    slots = slots.where(F.col("slot.window").isin(NUMBER, UNIT, NAME))
    named = F.when(F.col("slot.window") == NAME, F.concat(F.lit("="), F.col("slot.a")))
    slots = slots.select(
        "id", "item_id", "found", "place", "at", F.col("slot.g").alias("stands_for"),
        F.coalesce(named, (F.col("place") + F.col("pos")).cast("string")).alias("value"),
    )
    occurrence = ["id", "item_id", "found"]
    votes = slots.groupBy(*occurrence, "value", "stands_for").agg(F.count(F.lit(1)).alias("n"))
    bound = votes.groupBy(*occurrence, "value").agg(
        F.min(F.struct((-F.col("n")).alias("rank"), "stands_for"))["stands_for"].alias("bound")
    )
    odd = slots.join(bound, [*occurrence, "value"]).where("stands_for != bound")
    window = [*occurrence, "place", "at"]
    agreed = met.join(odd.select(*window).distinct(), window, "left_anti")
    counted = agreed.groupBy(*occurrence, "windows").agg(F.count_distinct("hash").alias("matched"))
    counted = counted.where(F.col("matched") >= COVERED * F.col("windows"))
    rank = F.struct((F.col("matched") / F.col("windows")).alias("coverage"), "windows", "matched")
    return counted.groupBy("id", "item_id").agg(F.max(rank).alias("best")).select("id", "item_id", "best.windows", "best.matched")


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item; a row with a null id is kept, as it can't be judged."""
    found = leaks(docs, benchmark, doc_id, text).select(F.col("doc_id").alias("_leaked")).distinct()
    found = small(stored(found, "leaked"))
    numbered = docs.toDF(*(f"_{at}" for at in range(len(docs.columns))))
    place = docs.columns.index(doc_id)
    kept = numbered.join(found, F.col(f"_{place}") == F.col("_leaked"), "left_anti")
    return kept.toDF(*docs.columns)
