"""MinHash near-duplicates with tensored banding.

Two collections of ``HALVES`` half keys, each made of ``DEPTH`` minhashes, are combined pair by
pair: ``HALVES ** 2`` tables, with keys of ``2 * DEPTH`` minhashes, cost ``2 * HALVES * DEPTH`` minhashes
instead of ``2 * HALVES ** 2 * DEPTH``. Documents at the threshold of 0.8 meet in one of 144 tables
with probability 0.9996, more similar ones more surely. Only documents that share a half key
of the first collection with another one get keys at all.

1. Equal sets are one set from here on.
2. Every member of a bucket is compared with the bucket's first set. Links join to components.
3. In a bucket of several components, sets of different components are compared too: as pairs
   up to ``SMALL`` sets. Sets that meet in larger buckets are one neighbourhood, over all tables: those
   outside its main component are compared with all of it, in tasks of bounded parts.

Every comparison counts the shared shingles of the full sets. A shingle is known by 64 bits of
hash, a set by 128.

Odd input: NULL text and text without words have no shingles and no links; rows of one id
and equal texts are of one component; a NULL id takes part and never names a component (NULL
if all of one are NULL); an empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import LOWER, save, texts, words
from surveylake.llm.components import components

SHINGLE, PERCENT = 2, 80
DEPTH, HALVES = 3, 12
#: Buckets of up to this many sets are compared as pairs; larger ones in parts of about so many.
SMALL, PART = 64, 2_048
#: Names that are hashed at a time.
GROUP_NAMES = 1 << 17
ODD = np.uint64(0x9E3779B97F4A7C15)
SIGNED = "doc_id long, n long, digest binary, text_md5 string, left array<long>, right array<long>"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Shingles:
    """Sorted distinct 64-bit names of a text's shingles; hashes of words are kept up to a bound."""

    KEPT = 200_000

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: bytes) -> np.ndarray:
        found = words(text.translate(LOWER))
        if len(self.known) > self.KEPT:
            self.known = {}
        known = self.known
        for word in set(found).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        if not len(hashes):
            return hashes
        size = min(self.size, len(hashes))
        names = np.full(len(hashes) - size + 1, size, np.uint64)  # a short text is one shingle of its own kind
        for i in range(size):
            names = mixed(names * ODD + hashes[i:len(hashes) - size + 1 + i])
        return np.unique(names)


def half_keys(names: list[np.ndarray], depth: int = DEPTH, halves: int = HALVES) -> np.ndarray:
    """The half keys of both collections of each set, of ``depth`` minhashes each; no set is empty."""
    number = 2 * halves * depth
    seeds = mixed(np.arange(1, number + 1, dtype=np.uint64) * ODD)
    flat, starts = np.concatenate(names), np.r_[0, np.cumsum([len(x) for x in names])[:-1]]
    least = np.stack([np.minimum.reduceat((flat ^ seed) * (seed | np.uint64(1)), starts) for seed in seeds])
    keys = np.zeros((2 * halves, len(names)), np.uint64)
    for part in least.reshape(2 * halves, depth, len(names)).transpose(1, 0, 2):
        keys = mixed(keys * ODD + part)
    return keys.view(np.int64).reshape(2, halves, len(names)).transpose(2, 0, 1)


def _signed(shingle: int):
    kind = pa.list_(pa.int64())

    def signed(batch: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        some = [x for x in sets if len(x)]
        keys = iter(half_keys(some)) if some else iter(())
        halves = [next(keys) if len(x) else ([], []) for x in sets]
        digests = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(digests, pa.binary()), batch.column("text_md5"),
             pa.array([x[0] for x in halves], kind), pa.array([x[1] for x in halves], kind)],
            ["doc_id", "n", "digest", "text_md5", "left", "right"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            sets, size, first = [], 0, 0
            for at, text in enumerate(texts(batch)):
                sets.append(shingles(text))
                size += len(sets[-1])
                if size >= GROUP_NAMES:
                    yield signed(batch.slice(first, at + 1 - first), sets)
                    sets, size, first = [], 0, at + 1
            if sets:
                yield signed(batch.slice(first), sets)

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("u"), pa.array([shingles(t).tobytes() for t in texts(batch)], pa.binary())], ["u", "names"])

    return run


def _compared(percent: int):
    """Pairs that are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("names_u"), batch.column("names_v")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _spanned(percent: int):
    """Links of the sets that ask with the others: less than one per set. Sets of one label are joined already."""
    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        if not asks.any() or asks.all():
            return table.select(["u"]).slice(0, 0).append_column("v", pa.array([], pa.int64()))
        ids, label = table.column("u").to_numpy(), np.unique(table.column("label").to_numpy(), return_inverse=True)[1]
        found = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("names")]
        answers = np.flatnonzero(~asks)
        sizes = np.array([len(found[i]) for i in answers])
        names, name = np.unique(np.concatenate([found[i] for i in answers]), return_inverse=True)
        holders = np.repeat(np.arange(len(answers)), sizes)[np.argsort(name, kind="stable")]
        starts = np.r_[0, np.bincount(name).cumsum()]
        links = []
        for i in np.flatnonzero(asks).tolist():
            at = np.minimum(np.searchsorted(names, found[i]), len(names) - 1)
            at = at[names[at] == found[i]]
            others = np.concatenate([holders[:0], *[holders[starts[x]:starts[x + 1]] for x in at.tolist()]])
            both = np.bincount(others, minlength=len(answers))
            similar = (100 * both >= percent * (sizes + len(found[i]) - both)) & (label[answers] != label[i])
            for j in answers[similar].tolist():
                if label[j] != label[i]:
                    links.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
                    label[label == label[j]] = label[i]
        u, v = zip(*links) if links else ((), ())
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def buckets(sets: DataFrame) -> DataFrame:
    """(key, u) of all sets that share a table key with another one."""
    left = sets.select("u", F.posexplode("left").alias("i", "half"), "right")
    shared = left.groupBy("i", "half").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    rows = left.join(shared, ["i", "half"]).select("u", "i", "half", F.posexplode("right").alias("j", "other"))
    return rows.select("u", F.xxhash64("i", "half", "j", "other").alias("key"))


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (u > v) whose full sets are similar enough."""
    pairs = pairs.join(sets.withColumnRenamed("names", "names_u"), "u")
    pairs = pairs.join(sets.select(F.col("u").alias("v"), F.col("names").alias("names_v")), "v")
    return pairs.select("u", "v", "names_u", "names_v").mapInArrow(_compared(percent), "u long, v long")


def neighbours(rows: DataFrame, names: DataFrame, percent: int, part: int) -> DataFrame:
    """Links between the components that meet in large buckets.

    Sets that buckets join, directly or over others, are one neighbourhood, whatever the number of tables
    they meet in. Sets outside its most frequent component are compared with all its sets, part by part.
    """
    reached = components(rows.where("u > first").select("u", F.col("first").alias("v")))
    sets = rows.select("u", "label").distinct().join(reached.withColumnRenamed("label", "hood"), "u", "left").withColumn("hood", F.coalesce("hood", "u"))
    sizes = sets.groupBy("hood", "label").agg(F.count("*").alias("n")).groupBy("hood").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("main"))
    sets = sets.join(sizes.select("hood", "n", F.col("main.n").alias("most"), F.col("main.label").alias("main")), "hood")
    spread = lambda n: F.greatest(F.lit(1), F.ceil(n / part).cast("int"))
    place = lambda n: F.pmod(F.xxhash64("u"), spread(n)).cast("int")
    all_, others = F.col("n"), F.col("n") - F.col("most")
    right = sets.select("hood", "u", "label", F.explode(F.sequence(F.lit(0), spread(others) - 1)).alias("p"), place(all_).alias("q"), F.lit(False).alias("asks"))
    left = sets.where("label <> main").select("hood", "u", "label", place(others).alias("p"), F.explode(F.sequence(F.lit(0), spread(all_) - 1)).alias("q"), F.lit(True).alias("asks"))
    cells = left.unionByName(right).join(names, "u")
    return cells.groupBy("hood", "p", "q").applyInArrow(_spanned(percent), "u long, v long").distinct()


def links(sets: DataFrame, docs: DataFrame, shingle: int, percent: int, small: int = SMALL, part: int = PART) -> DataFrame:
    """(u, label) of every set that is linked, but for the smallest of its component, which is the label."""
    rows = save(buckets(sets))
    shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("u").alias("first")).where("n > 1")
    rows = save(rows.join(shared, "key"))
    wanted = sets.join(rows.select("u").distinct(), "u").select("u", "text_md5")
    found = docs.select(F.md5(F.col("text").cast("binary")).alias("text_md5"), "text").groupBy("text_md5").agg(F.first("text").alias("text"))
    names = save(found.join(wanted, "text_md5").select("u", "text").mapInArrow(_sets(shingle), "u long, names binary"))
    stars = rows.where("u > first").select("u", F.col("first").alias("v")).distinct()
    edges = save(similar(stars, names, percent))
    labels = components(edges)

    labelled = rows.join(labels, "u", "left").select("key", "u", "n", "first", F.coalesce("label", "u").alias("label"))
    mixed_ = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    mixed_ = save(labelled.join(mixed_, "key"))
    rest = mixed_.where(F.col("n") <= small).groupBy("key").agg(F.collect_list(F.struct("u", "label")).alias("all"))
    rest = rest.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b"))
    pairs = rest.where("a.u > b.u AND a.label <> b.label").select(F.col("a.u").alias("u"), F.col("b.u").alias("v")).distinct().join(stars, ["u", "v"], "left_anti")
    spanned = neighbours(mixed_.where(F.col("n") > small), names, percent, part)
    more = save(similar(pairs, names, percent).unionByName(spanned))
    if more.isEmpty():
        return labels
    return components(edges.unionByName(more))


def near_duplicate_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, small: int = SMALL, part: int = PART) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row; texts whose sets of word shingles overlap by ``percent`` of their union are linked."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = save(docs.withColumn("text_md5", F.md5(F.col("text").cast("binary"))).select("doc_id", "text", "text_md5").mapInArrow(_signed(shingle), SIGNED))
    sets = rows.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.min("text_md5").alias("text_md5"), F.first("left").alias("left"), F.first("right").alias("right"))
    sets = save(sets.withColumn("u", F.monotonically_increasing_id()))
    labels = links(sets, docs, shingle, percent, small, part)
    named = sets.select("u", "digest", "first").join(labels, "u", "left").withColumn("label", F.coalesce("label", "u"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = named.join(least, "label").select("digest", "component_id")
    none = F.col("n") == 0
    return rows.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(none, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
