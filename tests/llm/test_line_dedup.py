import re
from collections import defaultdict

from kerbside.llm.line_dedup import without_boilerplate
from tests.llm.helpers import SMALL, documents


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")


def brute(rows, sites):
    spread, first = defaultdict(set), {}
    lines = [(doc_id, text, site, text.split("\n") if text is not None else []) for doc_id, text, site in rows]
    for doc_id, _, site, all_ in lines:
        for place, line in enumerate(map(normal, all_)):
            spread[line] |= {site} - {None}
            here = (doc_id is None, doc_id, place)
            first[line] = min(first.get(line, here), here)
    bad = {line for line, on in spread.items() if len(on) >= sites and len(line.split(" ")) >= 3}
    out = []
    for doc_id, text, _, all_ in lines:
        kept = [x for at, x in enumerate(all_) if normal(x) not in bad or first[normal(x)] == (doc_id is None, doc_id, at)]
        out.append((doc_id, "\n".join(kept) if text is not None else None, len(all_), len(all_) - len(kept)))
    return sorted(out, key=str)


def got(df, sites):
    out = without_boilerplate(df, sites)
    names = out.columns
    at = [names.index("doc_id"), names.index("text"), len(names) - 2, len(names) - 1]
    return sorted((tuple(row[place] for place in at) for row in out.collect()), key=str)


def test_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(row.doc_id, row.text, row.source) for row in docs.collect()]
    for sites in (2, 5):
        want = brute(rows, sites)
        assert got(docs, sites) == want
        assert any(row[3] for row in want)


def test_edges(spark):
    rows = [(at, f"Own text {at} here\n all  Rights\treserved now \nend", f"s{at % 4}") for at in range(12)]
    rows += [
        (20, None, "s1"),
        (21, "", None),
        (22, "All rights reserved now", None),
        (None, "all rights reserved now", "s9"),
        (23, "\n".join(["all rights reserved now", "x y z"] * 5000), "s1"),
        (0, rows[0][1], "s0"),
        (24, "two words\ntwo words", "s5"),
    ]
    table = documents(spark, rows)
    for sites in (4, 5, 6):
        assert got(table, sites) == brute(rows, sites)
    out = without_boilerplate(table, 4, lengths="n_chars")
    assert out.columns[: len(table.columns)] == table.columns
    lengths = {row[0]: (len(row[1]), row[4]) for row in out.collect() if row[1] is not None and row[0] not in (None, 0)}
    assert all(a == b for a, b in lengths.values())
    assert without_boilerplate(documents(spark, [])).count() == 0


def test_near_the_threshold_counts_are_exact(spark):
    """Some hundred sites, where a sketch alone would err."""
    rows = [(at, f"line {at % 7} of many words\nown {at} line text", f"site{at}") for at in range(1400 + 6)]
    assert got(documents(spark, rows), 201) == brute(rows, 201)
