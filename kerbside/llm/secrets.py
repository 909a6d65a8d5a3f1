"""Secret scans with corpus-wide ownership frequency.

Native. Three fixed patterns give the base spans. A wider pattern gives candidates: long mixed tokens.
For the value of every span the corpus is asked how many owners and repositories hold it: a value that
many copied is an example; a candidate that is none looks live and becomes a span as well.
Only 128-bit hashes of the values leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import pick, stored
from kerbside.llm.spans import matches, with_crossed

# Fixed patterns of the base spans.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE_LENGTH = 6
#: Long tokens; with lower and upper case letters and digits they are candidates.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "generic")

#: A value with at least so many owners, or repositories, is a widely copied example.
COPIED_OWNERS, COPIED_REPOSITORIES = 3, 5

_SPAN = "struct<start:int,rank:int,kind:string,end:int,one:bigint,two:bigint>"


def _spans(text: Column, pattern: str, kind: str, group: int = 0, kept=None) -> Column:
    """Leftmost non-overlapping matches with their places in code points, and two hashes of the value."""

    def entry(start: Column, end: Column, match: Column, before: Column, after: Column) -> Column:
        value = F.regexp_extract(match, pattern, group) if group else match
        span = F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            end.alias("end"),
            F.xxhash64(value).alias("one"),
            F.xxhash64(F.lit(1), value).alias("two"),
        )
        return F.when(kept(value), span) if kept else span

    return F.array_compact(matches(text, pattern, entry)).cast(f"array<{_SPAN}>")


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": _spans(text, ASSIGN, "assign", 2, lambda value: F.length(value) >= VALUE_LENGTH),
        "access": _spans(text, ACCESS, "access"),
        "hex": _spans(text, HEX, "hex"),
    }


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, by start and then kind, joined by commas."""
    one = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(one, ",")


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "lang",
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_generic, n_copied, base_sha256, spans, classes), one row per row.

    Base spans always stay. Candidates are tokens of 20 and more characters with both cases and digits, outside base
    spans. Every value is of one of two classes: copied, a widely copied example, if at least 3 owners or 5
    repositories of the corpus have it, else live. Live candidates are added to ``spans`` (``n_generic`` of them);
    ``n_copied`` counts the copied base spans and candidates. ``classes`` lists all base spans and candidates as
    kind:start:end:class, in the order of ``spans``. A repository is a value of ``repository`` within an owner, so
    copies within one repository say nothing.

    A null text counts as empty; a document without spans has empty ``spans`` and ``classes`` and the digest of the
    empty string. A null owner or repository counts as the empty one. Repeated rows are rows of their own; they add no
    owner. Texts are read whole, in time n log n in their matches. An empty table gives no rows. Other columns are
    not looked at.
    """
    docs = pick(docs, doc_id=doc_id, text=text, owner=owner, repository=repository)
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    found = docs.select("doc_id", "owner", "repository", "text", F.monotonically_increasing_id().alias("uid"))
    found = found.withColumns(base_spans(F.col("text")))
    found = found.withColumn("generic", _spans(F.col("text"), TOKEN, "generic", 0, _mixed)).drop("text")
    base = F.array_sort(F.concat("assign", "access", "hex"))
    found = stored(
        found.select(
            "uid",
            "doc_id",
            "owner",
            "repository",
            *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]),
            base.alias("base"),
            "generic",
        ),
        "spans",
    )
    owner, repository = (F.coalesce(name, F.lit("")).alias(name) for name in ("owner", "repository"))
    spans = found.select("uid", owner, repository, F.inline(F.concat("base", "generic")))
    is_base = F.col("kind") != "generic"
    spans = with_crossed(spans, is_base).where(is_base | ~F.col("crossed")).drop("crossed")
    spans = stored(spans, "candidates")
    holders = spans.select("one", "two", "owner", "repository").distinct()
    spread = stored(
        holders.groupBy("one", "two").agg(
            F.count_distinct("owner").alias("owners"), F.count(F.lit(1)).alias("repositories")
        ),
        "ownership",
    )
    copied = (F.col("owners") >= COPIED_OWNERS) | (F.col("repositories") >= COPIED_REPOSITORIES)
    judged = spans.join(spread, ["one", "two"]).withColumn("copied", copied)
    place = F.struct("start", "rank", "kind", "end", "copied")
    judged = judged.groupBy("uid").agg(F.collect_list(place).alias("all"), F.count(F.when(F.col("copied"), 1)).alias("n_copied"))
    out = found.join(judged, "uid", "left")
    every = F.coalesce("all", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,copied:boolean>>"))
    live = F.filter(every, lambda s: (s["kind"] != "generic") | ~s["copied"])
    named = F.transform(
        F.array_sort(every),
        lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"], F.when(s["copied"], "copied").otherwise("live")),
    )
    return out.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.size(F.filter(live, lambda s: s["kind"] == "generic")).cast("long").alias("n_generic"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
        spelled(live).alias("spans"),
        F.array_join(named, ",").alias("classes"),
    )
