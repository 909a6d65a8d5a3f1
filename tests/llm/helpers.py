"""Small tables and brute-force versions of the operators."""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    """(doc_id, text, source) rows as a table, with columns that clash in all but case."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})
    clashing = {"TEXT": F.lit("x"), "Doc_ID": F.lit(1), "component_id": F.lit(2), "node": F.lit(3), "_1": F.lit(4)}
    return df.select("*", *(value.alias(name) for name, value in clashing.items()))


def union_find(nodes, links):
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[at : at + 5]) for at in range(len(words) - 4)}


def near_groups(rows):
    """doc_id -> (size of its set, component), by comparing all that share a shingle."""
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    holders = defaultdict(list)
    for doc_id, one in sets.items():
        for shingle in one:
            holders[shingle].append(doc_id)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    groups = union_find(sets, links)
    return {doc_id: (len(sets[doc_id]), groups[doc_id]) for doc_id in sets}
