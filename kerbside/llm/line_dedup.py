"""Cross-site boilerplate: lines that occur on many sites, by HyperLogLog sketches and exact recounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import pick, small, stored

#: A line on at least this many different sites is boilerplate.
SITES = 5
#: Estimates within this share of the threshold are recounted exactly (6 standard errors at 2^LG_K registers).
BAND = 0.10
LG_K = 12
#: Lines with fewer words are headings, list marks or blanks; they are never removed.
WORDS = 3

_SPACE = r"[\x20\x09-\x0D]+"


def normal_line(line: Column) -> Column:
    """As lines are compared: lower case, inner space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), _SPACE, " "))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, body, site, place, one, two): a 128-bit hash for every line that is long enough to count."""
    lines = docs.select("doc_id", "body", "site", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    lines = lines.withColumn("line", normal_line(F.col("line")))
    lines = lines.where(F.size(F.split("line", " ")) >= WORDS)
    hashes = (F.xxhash64("line").alias("one"), F.xxhash64(F.lit(1), "line").alias("two"))
    return lines.select("doc_id", "body", "site", "place", *hashes)


def _spread(lines: DataFrame, sites: int) -> DataFrame:
    """(one, two, estimate, first): lines that may be on enough sites.

    Each task makes a sketch per line, and sketches are merged; the first occurrence (smallest doc_id,
    then place) comes from the same aggregation. A line seen less often than the threshold is out.
    """
    merged = lines.groupBy("one", "two").agg(
        F.count(F.lit(1)).alias("times"),
        F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "place")).alias("first"),
    )
    seen = merged.where(F.col("times") >= sites).withColumn("estimate", F.hll_sketch_estimate("sketch"))
    return seen.where(F.col("estimate") >= (1 - BAND) * sites).select("one", "two", "estimate", "first")


def repeated_lines(
    docs: DataFrame, sites: int = SITES, doc_id: str = "doc_id", text: str = "text", site: str = "source"
) -> DataFrame:
    """(doc_id, body, places): for documents with boilerplate, the numbers of the lines to remove.

    ``body`` is a hash of the text; with the id it names a row. See ``without_boilerplate``.
    """
    docs = pick(docs, doc_id=doc_id, text=text, site=site).withColumn("body", F.xxhash64("text"))
    lines = _lines(docs)
    spread = stored(_spread(lines, sites), "spread")
    met = stored(lines.join(small(spread), ["one", "two"]), "met-lines")
    near = spread.where(F.col("estimate") <= (1 + BAND) * sites).select("one", "two")
    exact = met.join(small(near), ["one", "two"], "left_semi").where("site is not null")
    exact = exact.select("one", "two", "site").distinct().groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"))
    sure = spread.where(F.col("estimate") > (1 + BAND) * sites).select("one", "two")
    out = stored(sure.unionByName(exact.where(F.col("n") >= sites).select("one", "two")), "boilerplate")
    here = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "place")
    gone = met.where(~here.eqNullSafe(F.col("first"))).join(small(out), ["one", "two"], "left_semi")
    return gone.groupBy("doc_id", "body").agg(F.collect_set("place").alias("places"))


def without_boilerplate(
    docs: DataFrame,
    sites: int = SITES,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    lengths: str | None = None,
) -> DataFrame:
    """``docs`` with (n_lines, n_removed) added and cross-site boilerplate lines taken out of the text.

    A line is boilerplate if its normal form (lower case, single blanks, at least 3 words) occurs on
    at least ``sites`` different sites. Its first occurrence (smallest doc_id, then place) stays, so
    that text which was copied whole to many sites is not lost everywhere; all others go.

    A null text stays null and has 0 lines; an empty one has one empty line. A document may end with
    an empty text; no document goes. A null site counts as no site. A null doc_id comes after all
    others as first occurrence. Repeated rows are treated alike (rows that repeat the first occurrence
    all keep the line). Texts are read whole. An empty table gives no rows. Other columns, whatever
    their names, are passed on.
    """
    places = repeated_lines(docs, sites, doc_id, text, site).toDF("_id", "_body", "_places")
    names = docs.columns
    rows = docs.toDF(*(f"_{at}" for at in range(len(names))))
    the_id, the_text = F.col(f"_{names.index(doc_id)}"), F.col(f"_{names.index(text)}")
    met = rows.join(places, the_id.eqNullSafe(F.col("_id")) & (F.xxhash64(the_text) == F.col("_body")), "left")
    lines = F.split(the_text, "\n")
    kept = F.array_join(F.filter(lines, lambda line, at: ~F.array_contains(F.col("_places"), at)), "\n")
    clean = F.when(F.col("_places").isNull(), the_text).otherwise(kept)
    columns = [F.col(f"_{at}") for at in range(len(names))]
    columns[names.index(text)] = clean
    if lengths in names:
        old = columns[names.index(lengths)]
        kind = docs.schema[names.index(lengths)].dataType
        columns[names.index(lengths)] = F.when(F.col("_places").isNull(), old).otherwise(F.length(clean).cast(kind))
    n_lines = F.coalesce(F.when(the_text.isNotNull(), F.size(lines)), F.lit(0))
    n_removed = F.coalesce(F.when(F.col("_places").isNotNull(), F.size("_places")), F.lit(0))
    return met.select(*columns, n_lines, n_removed).toDF(*names, "n_lines", "n_removed")
