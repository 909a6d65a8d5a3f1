"""URL rules, and redirect equivalence: a block reaches every alias of a blocked page.

Native. Rules are matched row by row. Redirects (``meta refresh``) and canonical links found in the
pages are edges between addresses; connected components over them are the alias groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import pick, stored
from kerbside.llm.components import components

ALLOW, BLOCK = "allow", "block"
#: (verdict, host with path); fixed by the query.
RULES = (
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A link or meta tag: its attributes, in any order, within one tag.
_CANONICAL = r"""(?i)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?i)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>;]+)"""


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def address_of(url: Column) -> Column:
    """What names a page: host, path and query. The scheme and the fragment do not."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.concat(host_of(url), path_of(url), query)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null. Equal rules: the first counts.

    The rules are a short list given by the caller; they become one CASE expression.
    """
    ranked = sorted(rules, key=lambda rule: -len(rule[1]))
    out = None
    for verdict, rule in ranked:
        place = rule.index("/") if "/" in rule else len(rule)
        name, start = rule[:place], rule[place:]
        fits = (host == name) | host.endswith(f".{name}")
        fits = fits & path.startswith(start) if start else fits
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _without_dots(path: Column) -> Column:
    """The path with "." and ".." taken as in RFC 3986; those at the end leave a slash."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        up = F.regexp_replace(done, "/[^/]*$", "")
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.lit("/"), part))

    walked = F.aggregate(F.slice(parts, 2, F.size(parts)), F.lit(""), step)
    walked = F.when(path.rlike(r"/\.\.?$"), F.concat(walked, F.lit("/"))).otherwise(walked)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), walked).otherwise(path)


def target_of(link: Column, host: Column, path: Column) -> Column:
    """The address that a link of a page means, or null: absolute, or relative to scheme, host, folder or page.

    ``&amp;`` stands for ``&``. Links with another scheme than ``scheme://``, empty ones and fragments mean nothing.
    """
    link = F.regexp_replace(F.regexp_replace(link, r"(?i)&(?:amp|#38|#x26);", "&"), "#.*$", "")
    bare = F.regexp_extract(link, r"^[^?]*", 0)
    query = F.regexp_extract(link, r"\?.*$", 0)
    folder = F.regexp_replace(path, "[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(link == "", F.lit(None).cast("string"))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), address_of(link))
        .when(link.startswith("//"), address_of(F.concat(F.lit("x:"), link)))
        .when(link.startswith("/"), F.concat(host, _without_dots(bare), query))
        .when(link.startswith("?"), F.concat(host, path, query))
        .when(~link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(host, _without_dots(F.concat(folder, bare)), query))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(address, target): redirects and canonical links of pages with an address, from ``host``, ``path`` and ``html``."""
    found = F.array_union(
        F.regexp_extract_all("html", F.lit(_CANONICAL), 1), F.regexp_extract_all("html", F.lit(_REFRESH), 1)
    )
    links = pages.where("address != ''").select("address", "host", "path", F.explode(found).alias("link"))
    links = links.select("address", target_of(F.col("link"), F.col("host"), F.col("path")).alias("target"))
    return links.where("target != ''")


def judge_pages(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, aliased): one row per page.

    A page that a rule fits has that rule's verdict: an explicit allow is never overruled by an alias.
    A page without a rule is blocked if its alias group holds an address that a rule blocks and none
    that a rule allows (allow has precedence), else allowed. ``aliased`` tells whether the page has an
    alias. Targets that are not pages themselves belong to the group, with the rule that fits them; relative
    targets are taken from the page's own url (a ``base`` tag is not looked at).

    A null url, or one without ``://``, has an empty host and path, no rule and no alias; null or empty
    html has no links. Repeated rows are judged alike. An empty table gives no rows. Texts are read
    whole. Other columns are not looked at.
    """
    pages = pick(pages, page_id=page_id, url=url, html=html).select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        address_of(F.col("url")).alias("address"),
        "html",
    )
    edges = stored(alias_edges(pages), "aliases")
    groups = stored(components(edges, "address", "target"), "alias-groups")
    place = F.concat(F.lit("x://"), F.col("node"))
    verdict = rule_of(host_of(place), path_of(place), rules)["verdict"]
    decided = groups.groupBy("component").agg(
        F.max(F.when(verdict == BLOCK, 1).otherwise(0)).alias("blocks"),
        F.max(F.when(verdict == ALLOW, 1).otherwise(0)).alias("allows"),
    )
    members = stored(groups.join(decided, "component").select("node", "blocks", "allows"), "alias-verdicts")
    judged = pages.drop("html").join(members, pages.address == members.node, "left")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    by_alias = F.when((F.col("blocks") == 1) & (F.col("allows") == 0), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(
        "page_id",
        "host",
        "path",
        rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], by_alias).alias("verdict"),
        F.col("node").isNotNull().alias("aliased"),
    )
