"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are cut into five blocks; two that differ in at most three bits agree
in two blocks at least, so each of the ten pairs of blocks is a table of buckets.
In a task, the fingerprints of its buckets lie as 64 bit planes. For a shift s, all
neighbours s apart are compared at once: the planes' differences are added into
carry-save counters, one bit per pair, and words whose pairs are all beyond the
radius are given up. A bucket only reports edges that join something new, so a
group of n gives less than n edges, not n * n.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import LOWER, numbered, released, save, texts, unused, words
from surveylake.llm.components import components

SEED = 42
#: (first bit, bits) of the five blocks.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
RADIUS = 3
#: A bucket with more distinct fingerprints is compared in pairs of parts of about this size.
PART_ROWS = 8_192
#: Fingerprints a task compares at a time, whole buckets only.
BATCH_ROWS = 400_000


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 (seed 42) of all shingles; fewer words make one shingle, none gives 0."""
    found = words(text.translate(LOWER))
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts[:len(found) - shingle + 1].tolist(), ends[shingle - 1:].tolist())),
            np.uint64, len(found) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start:start + 65_536].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, print as a signed long) of each row's whole text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(released(_fingerprints(shingle)), "doc_id long, print long")


def _shifted(plane: np.ndarray, at: np.ndarray, shift: int) -> np.ndarray:
    word, bit = divmod(shift, 64)
    low = plane[at + word]
    if not bit:
        return low
    return low >> np.uint64(bit) | plane[at + word + 1] << np.uint64(64 - bit)


def _packed(bits: np.ndarray, words_: int) -> np.ndarray:
    out = np.zeros(words_ * 8, np.uint8)
    packed = np.packbits(bits, bitorder="little")
    out[:len(packed)] = packed
    return out.view("<u8")


def near_pairs(prints: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one group whose fingerprints differ in at most ``radius`` bits. Groups lie together, largest first."""
    n = len(prints)
    sizes = np.bincount(group)[group]
    width = -(-n // 64)
    counters = max(1, radius.bit_length())
    planes = [_packed((prints >> np.uint64(k) & np.uint64(1)).astype(np.uint8), 2 * width + 2) for k in range(64)]
    for shift in range(1, int(sizes[0]) if n else 0):
        lanes = int(np.searchsorted(-sizes, -shift))  # the lanes whose group is larger than the shift
        left = group[:lanes]
        right = group[shift:lanes + shift]
        valid = _packed(left[:len(right)] == right, width)
        at = np.flatnonzero(valid)
        alive = valid[at]
        sums = [np.zeros(len(at), np.uint64) for _ in range(counters)]
        for k, plane in enumerate(planes):
            carry = plane[at] ^ _shifted(plane, at, shift)
            for j in range(counters):
                sums[j], carry = sums[j] ^ carry, sums[j] & carry
            alive &= ~carry  # these have passed 2 ** counters - 1
            if k % 4 == 3:
                live = alive != 0
                if not live.all():
                    at, alive, sums = at[live], alive[live], [s[live] for s in sums]
                if not len(at):
                    break
        if len(at):
            lane, bit = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            if radius + 1 != 1 << counters:
                total = sum((sums[j][lane] >> bit.astype(np.uint64) & np.uint64(1)).astype(np.int64) << j for j in range(counters))
                lane, bit = lane[total <= radius], bit[total <= radius]
            first = at[lane] * 64 + bit
            if len(first):
                yield first, first + shift


def spanning_edges(prints: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what is linked inside each group: less than one per fingerprint."""
    order = np.lexsort((group, -np.bincount(group)[group]))
    prints, group = prints[order], np.unique(group[order], return_inverse=True)[1]
    root = np.arange(len(prints))
    out: list[tuple[int, int]] = []
    for first, second in near_pairs(prints, group, radius):
        new = root[first] != root[second]
        for a, b in zip(first[new].tolist(), second[new].tolist()):
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((a, b))
        if new.any():
            while True:  # flatten, so that pairs joined already are seen as such
                above = root[root]
                if (above == root).all():
                    break
                root = above
    found = np.array(out, np.int64).reshape(-1, 2)
    return prints[found[:, 0]], prints[found[:, 1]]


def _compared(radius: int):
    def edges(prints: list, groups: list) -> pa.RecordBatch:
        a, b = spanning_edges(np.concatenate(prints).view(np.uint64), np.concatenate(groups), radius)
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, groups, held, last, number = [], [], 0, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("table", "key", "part", "other")])
            new = np.any(keys[:, 1:] != keys[:, :-1], axis=0)
            starts_new = last is None or bool(np.any(keys[:, 0] != last))
            ids = np.concatenate(([int(starts_new)], new)).cumsum() + number
            last, number = keys[:, -1], int(ids[-1])
            prints.append(batch.column("print").to_numpy())
            groups.append(ids)
            held += batch.num_rows
            if held >= BATCH_ROWS:
                fp, gr = np.concatenate(prints), np.concatenate(groups)
                cut = int(np.searchsorted(gr, gr[-1]))  # the last group may go on
                if cut:
                    yield edges([fp[:cut]], [gr[:cut] - gr[0]])
                    prints, groups, held = [fp[cut:]], [gr[cut:]], len(fp) - cut
        if held:
            gr = np.concatenate(groups)
            yield edges(prints, [gr - gr[0]])

    return run


def linked(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u > v) between distinct ``print`` values that connect all at most ``radius`` (up to 3) bits apart."""
    if not 0 < radius <= RADIUS:
        raise ValueError(f"five blocks find up to {RADIUS} bits")
    tables = F.array(*[
        F.struct(
            F.lit(t).alias("table"),
            F.shiftleft(F.shiftrightunsigned("print", a[0]).bitwiseAND((1 << a[1]) - 1), b[1]).bitwiseOR(
                F.shiftrightunsigned("print", b[0]).bitwiseAND((1 << b[1]) - 1)).cast("int").alias("key"))
        for t, (a, b) in enumerate(combinations(BLOCKS, 2))])
    rows = prints.select("print", F.inline(tables))
    sizes = rows.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / PART_ROWS).cast("int")
    mine = F.pmod(F.xxhash64("print"), parts).cast("int")
    shared = rows.join(sizes, ["table", "key"]).select("table", "key", "print", mine.alias("mine"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("with"))
    shared = shared.select("table", "key", F.least("mine", "with").alias("part"), F.greatest("mine", "with").alias("other"), "print")
    keys = ["table", "key", "part", "other"]
    return shared.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(released(_compared(radius)), "u long, v long").distinct()


def one_of_each(docs: DataFrame, shingle: int, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, of a row without one if none has.

    Repeated rows are rows of one component, so one of them stays.
    """
    row = unused(docs, "_row")
    rows = numbered(docs, row)
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), shingle, radius).select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "row"))["row"]
    kept = found.join(ids, "row").groupBy("component_id").agg(first.alias(row)).select(row)
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(docs: DataFrame, shingle: int, radius: int = RADIUS) -> DataFrame:
    """(doc_id, print, component_id) of each row.

    ``component_id`` is the smallest doc_id that links reach. NULL and empty texts
    have fingerprint 0; repeated rows are rows of one component; a NULL doc_id takes
    part and never names a component (NULL if all of one are NULL).
    """
    rows = save(fingerprints(docs, shingle))
    distinct = rows.groupBy("print").agg(F.min("doc_id").alias("first"))
    distinct = save(distinct)
    labels = components(linked(distinct.select("print")))
    named = distinct.join(labels.withColumnRenamed("u", "print"), "print", "left").withColumn("label", F.coalesce("label", "print"))
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "label").select("print", "component_id")
    return rows.join(named, "print").select("doc_id", "print", "component_id")
