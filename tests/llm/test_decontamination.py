from collections import defaultdict

from kerbside.llm.decontamination import leaks, without_leaks
from tests.llm.helpers import MIDDLE, documents


def plain(text):
    """Words without marks, for texts without digits; names are told apart by the caller's tolerance."""
    words = [word.strip(".,;:!?\"'()%*#$&|") for word in (text or "").lower().split()]
    return [word for word in words if word]


def test_table_against_plain_passages(spark):
    """Documents that hold a whole item word for word, and no others."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    benchmark = spark.read.parquet(f"{MIDDLE}/benchmark.parquet")
    items = {row.item_id: plain(row.text) for row in benchmark.collect()}
    starts = defaultdict(list)
    for item_id, words in items.items():
        starts[tuple(words[:5])].append(item_id)
    want = set()
    for row in docs.select("doc_id", "text").collect():
        words = plain(row.text)
        for at in range(len(words) - 4):
            for item_id in starts.get(tuple(words[at : at + 5]), ()):
                if words[at : at + len(items[item_id])] == items[item_id]:
                    want.add((row.doc_id, item_id))
    got = {(row.doc_id, row.item_id) for row in leaks(docs, benchmark).collect()}
    assert want and got == want


ITEM = (
    "A train leaves Boston at 9:30 and travels 120 km to the coast in 2 hours. On the way back Alice meets the train "
    "after 45 km and asks how long the train from Boston would need for the rest of the way to the coast."
)


def test_reparameterised_questions(spark):
    other = ITEM.replace("Boston", "Lisbon").replace("9:30", "7").replace("120 km", "300 miles").replace("2 hours", "5h").replace("Alice", "Bob").replace("45 km", "45miles")
    loose = ITEM.replace("train from Boston", "train from Lisbon")  # one slot with two values
    torn = " ".join(ITEM.split()[::-1])
    half = " ".join(ITEM.split()[:20])
    filler = "some words that come before and after it all the same "
    rows = [
        (1, ITEM), (2, filler + other.upper().lower() + filler), (3, filler * 3 + "\n" + other + "\n" + filler), (4, loose),
        (5, torn), (6, half), (7, None), (8, ""), (9, filler * 5000 + ITEM), (None, ITEM), (1, ITEM), (10, ITEM + "\n" + other),
    ]
    items = spark.createDataFrame(
        [(1, ITEM), (1, ITEM), (2, "too short"), (3, None), (None, ITEM), (4, "1 2 3 4 5 6 7 8")], "item_id long, text string"
    ).selectExpr("*", "1 as TEXT", "2 as id", "3 as hash")
    table = documents(spark, [(*row, "s") for row in rows])
    got = {(row.doc_id, row.item_id): row for row in leaks(table, items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 1), (9, 1), (10, 1)}
    assert got[1, 1].coverage == 1.0 and got[3, 1].coverage == 1.0
    assert got[4, 1].matched < got[4, 1].windows
    kept = without_leaks(table, items)
    assert kept.columns == table.columns
    assert {row[0] for row in kept.collect()} >= {5, 6, 7, 8, None} and 9 not in {row[0] for row in kept.collect()}
    assert leaks(documents(spark, []), items).count() == 0 and leaks(table, items.limit(0)).count() == 0


def test_slots_must_agree(spark):
    """The same template with a different value at every meeting of a slot is another text."""
    item = " ".join(f"and then the man {name} went out to see {name} again" for name in ["Anna"] * 6)
    mixed = " ".join(f"and then the man {a} went out to see {b} again" for a, b in zip("Bea Cid Dan Eve Flo Gus".split(), "Hal Ida Jon Kim Lea Mia".split()))
    same = item.replace("Anna", "Otto")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    table = documents(spark, [(1, mixed, "s"), (2, same, "s")])
    assert {row.doc_id for row in leaks(table, items).collect()} == {2}


SHOP = (
    "The shop has {} red pens and {} blue pens on its shelf and then it sells {} red pens and {} blue pens "
    "so how many pens does it still have left"
)


def test_equal_numbers_are_slots_of_their_own(spark):
    """Numbers that happen to be equal in the item may differ in the document, also beside the original and variants."""
    item = SHOP.format(4, 4, 2, 2)
    variants = [SHOP.format(9, 7, 5, 3), SHOP.format(1, 2, 3, 4), SHOP.format(8, 6, 4, 2)]
    longer = variants[0].replace("on its shelf", "on its very long shelf")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, variants[0], "s"), (2, "\n".join([item, *variants]), "s"), (3, " ".join(variants), "s"), (4, longer, "s")]
    got = {row.doc_id: row.coverage for row in leaks(documents(spark, rows), items).collect()}
    assert got[1] == got[2] == got[3] == 1.0 and 0.75 <= got[4] < 1.0


def test_copies_in_another_case_or_layout_and_dense_items(spark):
    run = ITEM.replace("Boston", "New York").replace("Alice", "Ann Lee")
    dense = {2: "What is 12 * 7 + 5?", 3: "Compute 3/4 + 5/6 - 1/2.", 4: "Is Paris in France?"}
    items = spark.createDataFrame([(1, ITEM), *dense.items()], "item_id long, text string")
    rows = [(1, ITEM.lower()), (2, ITEM.upper()), (3, ITEM.replace(" ", "\n")), (4, run)]
    rows += [(10 + at, f"well, {text.lower()} we asked") for at, text in dense.items()]
    rows += [(20, "What is 12 * 7 + 6?"), (21, "is paris france in"), (22, "compute 3/4")]
    got = {(row.doc_id, row.item_id): row.coverage for row in leaks(documents(spark, [(*row, "s") for row in rows]), items).collect()}
    assert got == {(1, 1): 1.0, (2, 1): 1.0, (3, 1): 1.0, (4, 1): 1.0, (12, 2): 1.0, (13, 3): 1.0, (14, 4): 1.0}
