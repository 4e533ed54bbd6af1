from __future__ import annotations

import corpus_pipeline
from clickloom.llm import ngram_join

from .samples import sentences

NAMES = ["quality rules", "near duplicates", "personal data", "mixing", "packing"]


def text(seed):
    return "\n".join(f"The text {seed} says {sentences(f'{seed}-{i}', 9)} here." for i in range(10))


def test_stages_keep_columns_and_take_effect(spark, documents, tmp_path):
    own = text(1)
    rows = [(1, own, "a"), (2, own, "b"), (3, text(2) + "\nWrite to bob.k@example.com today.", "a"), (4, "short", "a")]
    rows += [(5, None, "a"), (6, "", None), (7, text(3), None)]
    docs = documents(*rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != NAMES[-1]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert {r.doc_id for r in seen[NAMES[0]]} == {1, 2, 3, 7}
    assert {r.doc_id for r in seen[NAMES[1]]} == {1, 3, 7}
    assert all("bob.k@example.com" not in r.text for r in seen[NAMES[2]])
    assert {r.doc_id for r in seen[NAMES[4]]} == {r.doc_id for r in seen[NAMES[3]]}


def test_run_takes_an_empty_table(spark, documents, tmp_path):
    documents("x").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_duplicates_keep_rows_without_id(spark, documents):
    own = text(1)
    rows = [(1, own, "a"), (2, own, "b"), (None, own, "a"), (None, text(2), "a"), (3, text(4), "a"), (4, "", "a")]
    got = corpus_pipeline.near_duplicates(spark, documents(*rows), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, own), (0, own), (0, text(2)), (3, text(4)), (4, "")])


def test_blocks_of_any_size_give_the_same_groups(spark, documents):
    own = [f"{sentences('group', 60)} {sentences(i, 2)}" for i in range(12)]
    docs = documents(*own, *[sentences(f"other{i}", 60) for i in range(4)])
    found = [
        sorted(map(tuple, ngram_join.jaccard_components(docs, 5, 80, block_elements=size).collect()))
        for size in (100, 1_200_000)
    ]
    assert found[0] == found[1]
    assert sum(c == 1 for *_, c in found[0]) == 12
