import corpus_pipeline
from kerbside.llm import toxicity
from kerbside.llm.common import table
from tests.llm.helpers import MIDDLE, near_groups
from tests.llm.test_line_dedup import brute as clean_lines


def test_stages_follow_their_contract(spark, tmp_path):
    docs = table(spark, MIDDLE, "documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, MIDDLE)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append((name, before, docs))
    assert [name for name, *_ in seen] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    assert all(after.columns == columns for _, _, after in seen[:-1])
    rows = lambda df: [tuple(row) for row in df.select("doc_id", "text", "source").collect()]

    # 1: exactly the documents go that the scores reject.
    scored = toxicity.score_toxicity(seen[0][1], table(spark, MIDDLE, "labels"))
    kept = {row.doc_id for row in scored.where("predicted = 0").collect()}
    assert {row[0] for row in rows(seen[0][2])} == kept
    # 2: brute force over the lines; no document goes.
    want = [(doc_id, text) for doc_id, text, _, _ in clean_lines(rows(seen[1][1]), 5)]
    assert sorted((row[:2] for row in rows(seen[1][2])), key=str) == sorted(want, key=str)
    assert seen[1][2].where("n_chars != length(text)").count() == seen[1][1].where("n_chars != length(text)").count()
    # 3: brute force over shingle sets.
    groups = near_groups([row[:2] for row in rows(seen[2][1])])
    assert {row[0] for row in rows(seen[2][2])} == {doc_id for doc_id, (_, group) in groups.items() if doc_id == group}
    # 4: some go, whole rows stay as they were.
    before, after = rows(seen[3][1]), rows(seen[3][2])
    assert set(after) < set(before)
    # 5: every document left is packed.
    assert {row.doc_id for row in seen[4][2].collect()} == {row[0] for row in after}


def test_run_equals_the_stages_in_documents(spark):
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert packed.select("doc_id").distinct().count() > 50
    assert corpus_pipeline.ORACLE_SQL is None
