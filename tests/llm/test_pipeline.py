"""The pipeline: each stage on a small corpus, and all of them in a row."""

import os

import corpus_pipeline
from tableferry.llm import queries
from tableferry.llm.components import stored

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts, characters = [docs.count()], [docs.selectExpr("sum(length(text))").first()[0]]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(spark, stage(spark, docs, SF_DIR), name)
        assert after.dtypes == docs.dtypes
        docs = after
        counts.append(docs.count())
        characters.append(docs.selectExpr("sum(length(text))").first()[0])
    assert counts == sorted(counts, reverse=True) and counts[2] < counts[1] and counts[4] < counts[3]
    assert counts[3] == counts[2] and characters[3] < characters[2]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.count() == counts[-1]
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, last.collect()))


def test_passages_of_over_fifty_words_stand_nowhere_twice(spark, documents, prose):
    passages = [prose(500 + i, 51) for i in range(8)]
    rows = [(i, f"{prose(i, 90)} {passages[i % 8]} {prose(100 + i, 90)}", "en", "s") for i in range(24)]
    rows += [(50, prose(777, 120), "en", "s"), (51, None, "en", "s"), (52, "", None, None)]
    docs = documents(rows)
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, SF_DIR).collect()}
    assert not [p for p in passages for t in left.values() if t and p in t]
    assert all(left[i].startswith(prose(i, 90)[:500]) for i in range(24))
    assert [left[i] for i in (50, 51, 52)] == [prose(777, 120), None, ""]


def test_stages_take_empty_tables_and_very_long_texts(spark, documents, prose, tmp_path):
    folder = str(tmp_path)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    long_text = prose(1, 150_000)
    spark.createDataFrame([(1, "an item of the benchmark with some words")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for rows in ([], [(1, long_text, "en", "a", len(long_text)), (2, prose(3, 200), "en", "b", 9)]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, folder)
            assert sorted(r["doc_id"] for r in out.collect()) == [r[0] for r in rows], name


def test_numbered_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registry()) == list(range(1, 14))
