"""Every operator that carries its input, and every stage, on rows without an id, repeated rows and clashing columns: the values."""

import collections
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from surveylake.llm import decontamination, lines, quality, simhash, suffixes

#: Names that the operators use inside.
CLASHING = ("_row", "_kept", "_stratum", "_toxic", "_n_words", "_cut_toxic", "_sum", "_sum2", "_spans", "_removed", "_doc", "_input",
            "row", "lang_", "stratum", "component_id", "print", "label", "first", "rank")


@pytest.fixture
def crowded(spark, small):
    """Documents of the given table, some repeated, some without an id, with columns of all names above."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    some = docs.where("doc_id < 12")
    odd = docs.unionByName(some).unionByName(some.withColumn("doc_id", F.lit(None).cast("long")))
    return odd.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING}).persist()


def bag(df, columns):
    return collections.Counter(tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in columns]).collect())


@pytest.mark.parametrize("stage", [s for s, _ in p.STAGES[:-1]])
def test_clashing_columns_change_nothing(spark, small, crowded, stage):
    run = dict(p.STAGES)[stage]
    plain = crowded.drop(*CLASHING)
    after = run(spark, crowded, small)
    assert after.columns == crowded.columns and after.dtypes == crowded.dtypes
    assert bag(after, plain.columns) == bag(run(spark, plain, small), plain.columns)
    for r in after.select("doc_id", *CLASHING).collect():
        assert all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING)


def test_packing_takes_clashing_columns(spark, small, crowded):
    packed = p.packing(spark, crowded, small).collect()
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == collections.Counter(r["doc_id"] for r in crowded.collect())


def test_one_row_of_a_group_stays(spark):
    text, other = " ".join(f"word{i}" for i in range(60)), " ".join(f"other{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, text), (None, text), (None, other), (None, other), (7, None), (9, ""), (3, text + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.one_of_each(docs, 5).collect()), key=str)
    assert kept == sorted([(1, text), (None, other), (7, None)], key=str)


def test_rows_without_an_id_lose_their_own_bytes(spark):
    """Three texts without an id, of which only the second repeats itself, and a fourth that repeats the first."""
    one, two, three = ("".join(f"{k}{i:03d}" for i in range(80)) for k in "abc")
    docs = spark.createDataFrame([(None, one), (None, two[:150] * 2), (None, three), (5, one)], "doc_id long, text string").coalesce(1)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in suffixes.remove_repeats(docs).collect())
    assert got == [(0, 300, 150), (0, len(one), 0), (0, len(three), 0), (5, len(one), len(one))]


def test_lines_count_in_a_free_column(spark):
    run = " ".join(["line"] * 60)
    docs = spark.createDataFrame([(1, run, 5), (2, run, 6)], "doc_id long, text string, _removed int")
    got = sorted(map(tuple, lines.dedup_lines(docs).collect()))
    assert got == [(1, run, 5, 0), (2, "", 6, 1)]


def test_lines_hold_few_windows_at_once():
    """200 texts of 2,000 lines of a word: 390,200 windows, of which a task holds some 65,536 with those of one text."""
    texts = ["\n".join(chr(97 + (i * k + k // 7) % 26) for k in range(2_000)) for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "_sum": list(range(200)), "text": texts})
    tracemalloc.start()
    rows = [b.num_rows for b in lines._windows(50)(iter([batch]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(rows) == 200 * (2_000 - 49) and max(rows) < lines.AT_ONCE + 2_000 and most < 40e6


def test_repeated_texts_are_no_further_evidence(spark):
    """98 good texts without a false rejection do not certify a limit of 2.5 %; neither do five copies of each, under one id or five; 490 texts do."""
    rules = quality.RULES
    limit, error = 0.025 * len(rules), 0.05 * len(rules)
    assert quality.binomial_below(0, 98, 0.025) > 0.05 > quality.binomial_below(0, 490, 0.025)
    for texts, copies, own, certified in ((98, 1, True, False), (98, 5, True, False), (98, 5, False, False), (490, 1, True, True)):
        good = [(i * 5 + (k if own else 0), f"t{i}", "en", 30, 0, *[-1e9] * len(rules)) for i in range(texts) for k in range(copies)]
        bad = [(10_000 + i, f"b{i}", "en", 30, 0, *[1e9] * len(rules)) for i in range(60)]
        scored = spark.createDataFrame(good + bad, "doc_id long, same string, lang string, _n_words long, _n_repeat_words long, " + ", ".join(f"_{r} double" for r in rules))
        worse = (F.col("doc_id") >= 10_000).cast("int")
        labels = scored.select("doc_id", (1 - worse).alias("quality"), worse.alias("toxic"))
        found = quality.cutoffs(scored, labels, labels.limit(0), "lang", limit, error).collect()
        assert [[x is not None for x in list(r)[1:]] for r in found] == [[certified] * len(rules)]


def test_plain_words_are_encoded_as_by_the_tokenizer():
    """Words that the ASCII path splits, and their neighbours that it must leave."""
    import struct

    from surveylake.llm.packing import WordIds
    from surveylake.llm.queries import tokenizer_file

    ids = WordIds(tokenizer_file())
    text = "Don't IT'S 's 'LL a1B22 3.14, (Foo) __Init__ x_y-Z ... J̌ay Café Ét İz <|endoftext|>x <|ENDOFTEXT|> \x01\x02Ab \x7f Kelvin H̱ K"
    for part in (text, *text.split()):
        found = ids.cut(part.encode())
        ids.add(set(found))
        raw = b"".join(ids.words[w] for w in found)
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == ids.whole.encode(part, add_special_tokens=False).ids
    assert ids.lowers and ids.cut(b"One TWO") == [b"one", b"two"]
