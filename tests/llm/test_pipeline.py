"""The five stages, one after another."""

import collections

import corpus_pipeline as p
import pyarrow as pa
from llm_helpers import documents
from surveylake.llm import packing
from surveylake.llm.common import kept, per_worker, released
from surveylake.llm.decontamination import _encoded
from surveylake.llm.queries import tokenizer_file


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs
    for name, stage in p.STAGES[:-1]:
        after = p.save(stage(spark, rows, small))
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert 0 < after.count() <= rows.count()
        assert after.join(rows, "doc_id", "left_anti").count() == 0
        rows = after
    packed = p.packing(spark, rows, small).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rows.collect()}
    used = collections.Counter()
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048


def test_stages_take_odd_rows(spark, small):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    text = " ".join(f"word{i}" for i in range(60))
    for rows in ([], [(None, None, None, None, None), (1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, None), (3, "", "en", "s", 0)]):
        docs = spark.createDataFrame(rows, schema)
        for _name, stage in p.STAGES:
            docs = p.save(stage(spark, docs, small))


def test_decontamination_takes_rows_without_an_id(spark, small, table):
    item = table("benchmark").first()["text"]
    docs = documents(spark, [item, "clean words only", item, "other words"], [None, None, 3, 3])
    kept = p.decontamination(spark, docs, small)
    assert kept.columns == docs.columns
    assert sorted(r["text"] for r in kept.collect()) == ["clean words only", "other words"]


def test_a_later_stage_drops_the_words_that_packing_kept():
    file = tokenizer_file()
    name = packing.cache(file)
    pack = released(packing._pieces(file, 2048, 0), name)
    search = released(_encoded({b"one": 0}))
    rows = lambda text: iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})])
    first = [r.to_pylist() for r in pack(rows("one two"))]
    words = per_worker(name, dict)
    assert b"two" in words.words
    list(pack(rows("three")))
    assert per_worker(name, dict) is words and b"two" in words.words  # kept from task to task
    assert [r["n_words"] for b in search(rows("one two")) for r in b.to_pylist()] == [2]
    assert name not in kept()
    assert [r.to_pylist() for r in pack(rows("one two"))] == first
