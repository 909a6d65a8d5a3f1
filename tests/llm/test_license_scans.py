import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm.license_scans import TEMPLATES, Templates, _of_chunk, scan_licenses
from tests.llm.helpers import MIDDLE, documents


def words(text):
    return re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode().lower())


def grams(text):
    found = words(text)
    return {*zip(found, found[1:])}


KNOWN = sorted(((len(grams(text)), name, grams(text)) for name, text in TEMPLATES), key=lambda row: row[:2])


def best(segment):
    mine = grams(segment)
    found = None
    for size, name, theirs in KNOWN if mine else ():
        dice = 2 * len(mine & theirs) / (len(mine) + size)
        if dice >= 0.75 and (found is None or dice > found[0]):
            found = (dice, name, len(mine))
    return found


def brute(rows):
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        blocks, block = [], []
        for at, line in enumerate([*lines, ""]):
            if any(ord(c) > 32 for c in line):
                block.append(at)
            elif block:
                blocks.append(block)
                block = []
        segments = [("line", [at]) for at in range(len(lines))] + [("paragraph", b) for b in blocks] + [("text", list(range(len(lines))))]
        seen = set()
        for level, numbers in segments:
            with_words = [at for at in numbers if words(lines[at])]
            if with_words and (span := (with_words[0], with_words[-1])) not in seen:
                seen.add(span)
                if found := best("\n".join(lines[at] for at in numbers)):
                    out.append((doc_id, found[1], level, *span, found[2], found[0]))
    return sorted(out, key=str)


def got(df):
    """The segments that the layout gives."""
    return sorted((tuple(row) for row in scan_licenses(df).where("level != 'window'").collect()), key=str)


def text_of(name, longest=True):
    return max((text for other, text in TEMPLATES if other == name), key=len if longest else lambda text: -len(text))


CODE = "\n".join(f"    value_{at} = call_{at % 7}(left, right)  # step {at}" for at in range(60))


def laid_out(text):
    """A notice as files have it: some sentences a paragraph, lines of a dozen words."""
    parts = re.split(r"(?<=[.:]) ", text)
    third = -(-len(parts) // 3)
    blocks = [" ".join(parts[at : at + third]) for at in range(0, len(parts), third)]
    return "\n\n".join(re.sub(r"((?:\S+ ){12})", r"\1\n", block) for block in blocks)


@pytest.mark.parametrize("name", sorted({name for name, text in TEMPLATES if len(text) > 150}))
def test_customary_layout_on_top_of_code(spark, name):
    notice = text_of(name)
    rows = [(1, f"Copyright (c) 2024 Somebody\n\n{laid_out(notice)}\n\n{CODE}"), (2, f"{CODE}\n{notice} {CODE}"), (3, CODE)]
    rows += [(4, f"{CODE}\n# x y z {text_of(name, False)} and more words behind it\n{CODE}")]
    found = scan_licenses(documents(spark, [(*row, "s") for row in rows])).collect()
    best = {}
    for row in sorted(found, key=lambda row: (row.bigrams, row.dice)):
        best[row.doc_id] = row.license
    assert best == {1: name, 2: name, 4: name}


def test_two_notices_in_one_text(spark):
    text = f"{laid_out(text_of('MIT'))}\n{CODE}\n{laid_out(text_of('Apache-2.0'))}"
    found = scan_licenses(documents(spark, [(1, text, "s")])).collect()
    assert {row.license for row in found if row.level == "window"} == {"MIT", "Apache-2.0"}


def test_windows_against_all_windows():
    """Whatever window of a text is similar enough, one that overlaps it is found, with its own true coefficient."""
    rng = random.Random(3)
    templates = [("a", "one two three four five six seven eight nine ten eleven twelve"), ("b", "red green blue red yellow black white")]
    held = Templates(templates, 0.75)
    for _ in range(150):
        rows = rng.choice(templates)[1].split()
        noise = [rng.choice(["x", "y", "one", "red", "blue", "two"]) for _ in range(rng.randint(0, 12))]
        mid = [word for word in rows if rng.random() > 0.08]
        text = " ".join(noise + mid + [rng.choice("pqr") for _ in range(rng.randint(0, 10))])
        data = np.frombuffer(text.encode(), np.uint8)
        out = list(_of_chunk(held, pa.array([1]), data, np.array([0, len(data)])))
        found = text.split()
        any_window = max(
            (2 * len({*zip(found[a:b], found[a + 1 : b])} & {*zip(t.split(), t.split()[1:])})
             / (len({*zip(found[a:b], found[a + 1 : b])}) + len({*zip(t.split(), t.split()[1:])})))
            for _, t in templates for a in range(len(found)) for b in range(a + 2, len(found) + 1)
        )
        assert bool(out) == (any_window >= 0.75), text
        assert all(row[6] <= any_window + 1e-12 for row in out)


def test_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    want = brute([(row.doc_id, row.text) for row in docs.collect()])
    assert want and got(docs) == want


def test_edges(spark):
    mit = text_of("MIT")
    wrapped = re.sub(r"((?:\S+ ){8})", r"\1\n# ", mit)
    changed = mit.replace("software", "library").replace("copies", "parts")
    rows = [
        (1, mit), (2, f"Intro words here.\n\n{wrapped}\n \nmore text"), (3, wrapped), (4, changed), (5, None), (6, ""),
        (7, "x\n" * 50_000 + "ALL RIGHTS RESERVED!\n" + "All rights"), (8, "mit"), (9, "all rights reserved rights all"),
        (None, "Released under the MIT-License"), (1, mit), (10, "Licensed under CC BY-SA-NC 4.0\r\nlicensed under cc by 4.0"),
    ]
    table = documents(spark, [(*row, "s") for row in rows])
    assert got(table) == brute(rows)
    assert got(documents(spark, [])) == [] and scan_licenses(table, []).count() == 0
