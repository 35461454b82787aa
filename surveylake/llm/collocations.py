"""Phrases whose words stand together more often than their parts let expect.

1. Texts are cut into chunks of bounded size. A chunk's task numbers its words and leaves
   the numbers in text order, with a break between pieces, and a count per word.
2. Words that are frequent in their language get global ids of 32 bits; a chunk meets only its
   own words again, so no dictionary is sent to all tasks.
3. A chunk counts its pairs of frequent words in a counting quotient filter. Filters are cut by
   quotient ranges, and the sorted parts of one range are merged over all chunks.
4. Phrases of three words are counted the same way where their pairs are frequent, longer ones where
   all their phrases of three are; no others can be frequent. A chunk meets only its own frequent ones.

Ids of the counted n-grams come back from the filter by undoing the permutation, so counts
are exact. Scores are integers of up to 38 digits.

Odd input: NULL text and text without words have no phrases; NULL lang is ``und``; rows of
one id count each; an empty table has no phrases. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.llm.common import save, texts
from surveylake.llm.quotient import CountingQuotientFilter

LEAST, LONGEST, TOP = 100, 5, 2_000
#: Bytes of text in a chunk, and in what is cut into words at a time.
CHUNK_BYTES, CUT_BYTES = 8 << 20, 1 << 20
#: Words of text per range of quotients: bounds the filters that one task merges.
RANGE_WORDS = 1 << 20
#: Parts in which a language's best phrases are chosen before its whole.
RANK_PARTS = 64
#: Every end of a piece becomes a full stop, A-Z lower case, a tab a space.
PLAIN = bytes.maketrans(b",;:!?\x0a\x0b\x0c\x0d\t" + bytes(range(65, 91)), b"." * 9 + b" " + bytes(range(97, 123)))
STOP = re.compile(rb"\.")
CHUNKS = "chunk long, local int, lang string, word binary, n long, stream binary"
FILTERS = "chunk long, part int, n int, body binary"
#: Frequent n-grams with their counts; and those of a chunk, packed.
COUNTED = "n int, ids array<long>, f long, chunk long, grams binary"
COUNTED_COLUMNS = ["n", "ids", "f", "chunk", "grams"]
#: Words with their number in a task; and a chunk's words by their number in it and in the task, packed.
NAMED = "part int, number long, lang string, word binary, f long, chunk long, body binary"
NAMED_COLUMNS = ["part", "number", "lang", "word", "f", "chunk", "body"]
#: Rows that a task packs at a time.
PACKED_ROWS = 1 << 20


def cuts(text: bytes) -> Iterator[list[bytes]]:
    """Words and full stops of a plain text, some pieces at a time."""
    start = 0
    while start < len(text):
        found = STOP.search(text, start + CUT_BYTES)
        end = found.end() if found else len(text)
        yield text[start:end].replace(b".", b" . ").split()
        start = end


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, number = TaskContext.get().partitionId() << 32, itertools.count()

    def fresh() -> tuple[dict, list]:
        new = itertools.count(1).__next__
        return defaultdict(lambda: defaultdict(new, {b".": 0})), []

    def done() -> Iterator[pa.RecordBatch]:
        chunk, stream = first + next(number), np.concatenate(parts)
        counts = np.bincount(stream)
        rows: dict[str, list] = {c: [] for c in ("lang", "word", "local")}
        for lang, known in names.items():
            del known[b"."]
            rows["lang"] += [lang] * len(known)
            rows["word"] += known.keys()
            rows["local"] += known.values()
        n = len(rows["word"])
        local = np.array(rows["local"], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk] * n, pa.int64()), pa.array(local.astype(np.int32)), pa.array(rows["lang"], pa.string()), pa.array(rows["word"], pa.binary()),
             pa.array(counts[local]), pa.nulls(n, pa.binary())], ["chunk", "local", "lang", "word", "n", "stream"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk]), pa.array([-1], pa.int32()), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
             pa.array([stream.astype("<u4").tobytes()])], ["chunk", "local", "lang", "word", "n", "stream"])

    (names, parts), size = fresh(), 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
            for found in cuts(text.translate(PLAIN)):
                if found:
                    parts += [np.fromiter(map(names[lang].__getitem__, found), np.uint32, len(found)), np.zeros(1, np.uint32)]
                    size += sum(map(len, found)) + len(found)
                    if size >= CHUNK_BYTES:
                        yield from done()
                        (names, parts), size = fresh(), 0
    if parts:
        yield from done()


def _blocks(chunk: int, grams: np.ndarray, parts: int) -> list[tuple]:
    if not grams.shape[1]:
        return []
    return [(chunk, p, len(grams), f.to_bytes()) for p, f in CountingQuotientFilter.of(grams).parts(parts)]


def _table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)], ["chunk", "part", "n", "body"])


def _pairs(parts: int):
    """A chunk's stream in global ids (part -1), and its pairs."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([])
        local = np.frombuffer(left.column("stream")[0].as_py(), "<u4")
        known = np.zeros(int(local.max()) + 1, np.uint64)
        for start, body in zip(right.column("start").to_pylist(), right.column("body").to_pylist()):
            word, number = np.frombuffer(body, "<u4").reshape(-1, 2).T
            known[word] = number.astype(np.uint64) + np.uint64(start)
        ids = known[local]
        ids = ids[(ids != 0) | np.r_[True, ids[:-1] != 0]]
        at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
        chunk = key[0].as_py()
        return _table([(chunk, -1, 0, ids.astype("<u4").tobytes()), *_blocks(chunk, np.stack([ids[at], ids[at + 1]]), parts)])

    return run


def _among(grams: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which columns of ``grams`` are columns of ``known``; both have 32-bit values, two rows or more."""
    shift, there = np.uint64(32), np.ones(grams.shape[1], bool)
    if not known.shape[1]:
        return ~there
    left, right = grams[0] << shift | grams[1], known[0] << shift | known[1]
    for row in range(2, len(known)):  # a pair's number stands for it beside the next value
        pairs, number = np.unique(right, return_inverse=True)
        at = np.minimum(np.searchsorted(pairs, left), len(pairs) - 1)
        there &= pairs[at] == left
        left, right = at.astype(np.uint64) << shift | grams[row], number.astype(np.uint64) << shift | known[row]
    return there & np.isin(left, right)


def _longer(parts: int, known: int, sizes: range):
    """Phrases of ``sizes`` words, all of whose parts of ``known`` words are frequent."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table([])
        ids = np.frombuffer(left.column("body")[0].as_py(), "<u4").astype(np.uint64)
        grams = lambda n, at: np.stack([ids[at + i] for i in range(n)])
        frequent = np.frombuffer(b"".join(right.column("grams").to_pylist()), "<u4").reshape(-1, known).T.astype(np.uint64)
        part = _among(grams(known, np.arange(max(0, len(ids) - known + 1))), frequent)
        good, rows = part, []
        for n in range(known + 1, sizes.stop):
            good = good[:-1] & part[n - known:]
            if n in sizes:
                rows += _blocks(key[0].as_py(), grams(n, np.flatnonzero(good)), parts)
        return _table(rows)

    return run


def _merge(least: int, prunes: bool):
    """The frequent n-grams of one quotient range; and, if they prune longer ones, the chunks that have them."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        n = key[1].as_py()
        chunks = table.column("chunk").to_pylist()
        filters = [CountingQuotientFilter.from_bytes(b) for b in table.column("body").to_pylist()]
        whole = CountingQuotientFilter.merged(filters)
        keep = whole.counts >= least
        whole = CountingQuotientFilter(whole.limbs[:, keep], whole.counts[keep])
        ids = whole.ids()
        n_rows = ids.shape[1]
        flat = ids.T.astype(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * n_rows + 1, n), pa.int32()), pa.array(flat.ravel()))
        rows = [pa.table(
            [pa.array([n] * n_rows, pa.int32()), lists, pa.array(whole.counts), pa.nulls(n_rows, pa.int64()), pa.nulls(n_rows, pa.binary())], COUNTED_COLUMNS)]
        if prunes and n_rows:
            there = [(c, flat[_among(whole.limbs, f.limbs)]) for c, f in zip(chunks, filters)]
            there = [(c, p.astype("<u4").tobytes()) for c, p in there if len(p)]
            m = len(there)
            rows.append(pa.table(
                [pa.nulls(m, pa.int32()), pa.nulls(m, lists.type), pa.nulls(m, pa.int64()), pa.array([c for c, _ in there], pa.int64()), pa.array([p for _, p in there], pa.binary())],
                COUNTED_COLUMNS))
        return pa.concat_tables(rows)

    return run


def _key(ids: Column | str) -> Column:
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the words of a task, whose rows stand together: a row per word, and packed rows of a chunk's (local, number)."""
    part, number, last = TaskContext.get().partitionId(), -1, None
    held: dict[int, list] = defaultdict(list)
    size = 0

    def packed() -> pa.RecordBatch:
        chunks = sorted(held)
        bodies = [np.concatenate(held[c]).astype("<u4").tobytes() for c in chunks]
        n = len(chunks)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
             pa.array(chunks, pa.int64()), pa.array(bodies, pa.binary())], NAMED_COLUMNS)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c) for c in ("lang", "word")]
        new = np.ones(batch.num_rows, bool)
        for k in keys:
            same = pc.equal(k.slice(1), k.slice(0, len(k) - 1)).to_numpy(zero_copy_only=False)
            new[1:] = ~same if k is keys[0] else new[1:] | ~same
        first = tuple(k[0].as_py() for k in keys)
        new[0], last = last != first, tuple(k[-1].as_py() for k in keys)
        numbers = number + new.cumsum()
        number = int(numbers[-1])
        words = batch.filter(pa.array(new))
        n = words.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int32()), pa.array(numbers[new]), *[words.column(c) for c in ("lang", "word", "f")], pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
            NAMED_COLUMNS)
        chunk = batch.column("chunk").to_numpy()
        order = np.argsort(chunk, kind="stable")
        found, starts = np.unique(chunk[order], return_index=True)
        both = np.stack([batch.column("local").to_numpy(), numbers], axis=1)[order]
        for c, rows in zip(found.tolist(), np.split(both, starts[1:])):
            held[c].append(rows)
        size += batch.num_rows
        if size >= PACKED_ROWS:
            yield packed()
            size = 0
    if held:
        yield packed()


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n) of all words; (lang, word, f, id) of frequent words; (lang, n, ids, f) of frequent phrases of two words or more."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    chunks = save(docs.select(lang, F.col("text").cast("string").alias("text")).mapInArrow(_chunks, CHUNKS))
    words, streams = chunks.where("local >= 0").drop("stream"), chunks.where("local < 0").select("chunk", "stream")
    sizes = save(words.groupBy("lang").agg(F.sum("n").alias("n")))
    # A word has one row per chunk, so no word is hot.
    frequent = words.withColumn("f", F.sum("n").over(Window.partitionBy("lang", "word"))).where(F.col("f") >= least)
    frequent = frequent.select("chunk", "local", "lang", "word", "f")
    named = save(frequent.mapInArrow(_named, NAMED))
    # A row per partition of the frequent words, so that their numbers become ids from 1, without gaps.
    tasks = named.where("number IS NOT NULL").groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    starts = list(itertools.accumulate((r["n"] for r in tasks), initial=1))
    if starts[-1] > 1 << 32:
        raise ValueError("more frequent words than 32 bits can number")
    starts = F.broadcast(docs.sparkSession.createDataFrame([(r["part"], s) for r, s in zip(tasks, starts)], "part int, start long"))
    vocabulary = save(named.where("number IS NOT NULL").join(starts, "part").select("lang", "word", "f", (F.col("start") + F.col("number")).alias("id")))
    local = named.where("chunk IS NOT NULL").join(starts, "part").select("chunk", "start", "body")
    parts = max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // RANGE_WORDS))
    paired = streams.groupBy("chunk").cogroup(local.groupBy("chunk")).applyInArrow(_pairs(parts), FILTERS)
    paired = save(paired.withColumn("kind", F.when(F.col("part") < 0, "stream").otherwise("filter")), "kind")
    levels = [save(paired.where("kind = 'filter'").drop("kind").groupBy("part", "n").applyInArrow(_merge(least, longest > 2), COUNTED))]
    streams = paired.where("kind = 'stream'").select("chunk", "body").groupBy("chunk")
    # phrases of three words where both pairs are frequent, then all longer ones where their phrases of three are
    for known, lengths in ((2, range(3, min(longest, 3) + 1)), (3, range(4, longest + 1))):
        if lengths:
            frequent = levels[-1].where("chunk IS NOT NULL").select("chunk", "grams").groupBy("chunk")
            more = streams.cogroup(frequent).applyInArrow(_longer(parts, known, lengths), FILTERS)
            levels.append(save(more.groupBy("part", "n").applyInArrow(_merge(least, known == 2 and longest > 3), COUNTED)))
    phrases = reduce(DataFrame.unionByName, [x.where("n IS NOT NULL") for x in levels])
    langs = vocabulary.select("lang", F.col("id").alias("first"))
    phrases = phrases.withColumn("first", F.col("ids")[0]).join(langs, "first").select("lang", "n", "ids", "f")
    return sizes, vocabulary, save(phrases)


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to ``longest`` words of each language.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the cut with the smallest
    ``score``, and ``n`` the words of the language.
    """
    sizes, vocabulary, phrases = counted(docs, least, longest)
    counts = phrases.select(_key("ids").alias("key"), "f").unionByName(vocabulary.select(F.col("id").cast("string").alias("key"), "f"))
    cut = phrases.select("lang", "ids", "n", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cut = cut.select(
        "lang", _key("ids").alias("key"), "a", "k", _key(F.slice("ids", F.lit(1), F.col("k"))).alias("before"),
        _key(F.slice("ids", F.col("k") + 1, F.col("n") - F.col("k"))).alias("after"))
    cut = cut.join(counts.select(F.col("key").alias("before"), F.col("f").alias("l")), "before")
    cut = cut.join(counts.select(F.col("key").alias("after"), F.col("f").alias("r")), "after").join(sizes, "lang")
    score = F.expr("(cast(1000 * a as decimal(18,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(19,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "key", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("n") - size + 1), lambda at: _key(F.slice("ids", at, size)))))
    inside = phrases.where("n > 2").select(F.explode(spans).alias("key"), "f").groupBy("key").agg(F.max("f").alias("longer"))
    best = best.join(inside, "key", "left").where("longer IS NULL OR 100 * longer < 100 * a")
    spelt = best.select("key", F.posexplode(F.split("key", " ")).alias("at", "id")).withColumn("id", F.col("id").cast("long"))
    spelt = spelt.join(vocabulary.select("id", F.col("word").cast("string").alias("word")), "id").groupBy("key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = best.join(spelt, "key").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
