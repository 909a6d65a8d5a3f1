import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from kerbside.llm import pii
from kerbside.llm.queries import op12_pii
from tests.llm.helpers import MIDDLE, documents

# The contract's patterns as they are given.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        twice = [int(d) if at % 2 == 0 else sum(divmod(2 * int(d), 10)) for at, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    """Counts and spelled base spans."""
    spans = [
        (m.start(), at, m.end(), kind)
        for at, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    counts = [sum(span[1] == at for span in spans) for at in range(4)]
    return counts, ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))


def check(spark, rows):
    df = pii.scan(documents(spark, [(at, text, "s") for at, text in enumerate(rows)]))
    got = {row.doc_id: row for row in df.withColumn("base", pii.spelled(F.col("base"))).collect()}
    for at, text in enumerate(rows):
        counts, spelled = brute(text)
        assert got[at].base == spelled, repr(text)
        assert [got[at][f"n_{kind}"] for kind in BASE] == counts
    return got


def test_table_against_the_plain_patterns(spark):
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()
    got = {row.doc_id: row for row in op12_pii(spark, MIDDLE).collect()}
    assert len(got) == len(rows)
    for row in rows:
        counts, spelled = brute(row.text)
        assert [got[row.doc_id][f"n_{kind}"] for kind in BASE] == counts
        assert got[row.doc_id].base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert set(spelled.split(",")) - {""} <= set(got[row.doc_id].spans.split(","))


def test_base_on_odd_texts(spark):
    rng = random.Random(4)
    rows = [None, "", "a@b.c_d@e.f+1@g.h", "x@y.z@w.v", "@a.b a@.b a@b. a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.0004 01.002.0003.4"]
    rows += ["4111 1111 1111 1111", "4111-1111-1111-1111-", "41111111111111111111", "+1 (743) 555-3220.", "+1--2", "+12", "+1 ", "++1 23 45 67 89 01 2-"]
    rows += ["\U0001f600\U0001f600 a@b.cd é+49 30 1234567", "4111111111111111 10.0.0.1", "1-1", "1 1", "11", "1"]
    rows += ["".join(rng.choice("01249 .-+@ab()\n") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    check(spark, rows)


def test_long_texts_take_linear_time(spark):
    """Runs that a plain pattern would try again from each of their characters."""
    rows = ["x" * 400_000, "7" * 400_000, "a.b" * 100_000 + "@", "+1" + " " * 300_000, "1.2.3." * 60_000, "9 " * 40_000 + "a@b.c " * 40_000]
    df = pii.scan(documents(spark, [(at, text, "s") for at, text in enumerate(rows)]))
    got = {row.doc_id: row for row in df.drop("base", "spans").collect()}
    assert got[5].n_email == 40_000 and got[0].n_email == 0


def corpus():
    """Prose with strict data, failing look-alikes, and other spellings in the last rows."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    number = lambda size: "".join(rng.choice("0123456789") for _ in range(size))

    def data():
        yield f"{word()}.{word()}@{word()}.{rng.choice(['com', 'org', 'de'])}"
        yield ".".join(str(rng.randint(1, 255)) for _ in range(4))
        yield ".".join(str(rng.randint(300, 999)) for _ in range(4))
        yield f"+1 ({number(3)}) 555-{number(4)}"
        yield f"4{number(15)}"
        yield f"4{number(3)} {number(4)} {number(4)} {number(4)}"

    return [" ".join(word() for _ in range(9)) + " " + part + " " + word() for _ in range(300) for part in data()]


def test_other_spellings_are_added_and_clean_texts_left_alone(spark):
    plain = corpus()
    planted = {
        "write to jane.roe [at] mailhost [dot] com please": "email:9:41",
        "call me at (743) 555-3220 today": "phone:11:25",
        "the host 10[.]20[.]30[.]40 is down": "ip:9:26",
    }
    clean = ["nothing at all is here.", "in 2024 we sold 12 pens and 7 cups", "chapter 3.2 of part 4, page 118", "meet at noon"]
    rows = plain + list(planted) + clean
    got = check(spark, rows)
    spans = {at: row for at, row in got.items()}
    for at, text in enumerate(rows):
        spelled = ",".join(f"{pii.KINDS[s.rank]}:{s.start}:{s.end}" for s in sorted(spans[at].spans))
        if text in planted:
            assert spelled == planted[text], text
        if text in clean:
            assert spelled == "", text


@pytest.mark.parametrize("texts", [[], ["no data"], ["a@b.cd"]])
def test_nothing_to_learn_from(spark, texts):
    df = pii.scan(spark.createDataFrame([(None, text) for text in texts * 2], "doc_id long, text string"))
    assert [row.n_added for row in df.collect()] == [0] * len(texts) * 2
