"""Removal of repeated byte strings by prefix doubling of names.

The doubling is done in the tasks, on hashes, not by Spark sorts of rank pairs at growing
offsets until all ranks are unique; Spark sorts winnowed anchors. Names of substrings double in length (1, 2, 4, ... bytes) by pairing the names of
their halves; equal strings have equal names in every task, so a name serves as the
rank that a sort would give. Names of LONG bytes at all places would be far more
data than the text, so the sorts start at anchors: of every LONG-byte string the
start of its least GRAM-byte name, which equal strings choose alike (winnowing).

Round 1 sorts (GRAM-byte name, name of all that strings with this anchor can hold).
Anchors whose first name is unique are done: nothing over them repeats. An anchor
equal to an earlier one in both is done too: everything over it repeats. Round 2
sorts the remaining anchors again with the bytes around them and reranks their starts
at full length: each LONG-byte name but the first repeats. A gram with very many
anchors leaves that to a third round, in which Spark sorts single starts by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import numbered, save, texts

LONG, GRAM = 100, 24
#: Starts of grams in a LONG-byte string.
SPAN = LONG - GRAM + 1
#: Bytes of text that are named at a time; longer texts are cut into tiles that overlap.
CHUNK_BYTES = 2 << 20
#: What a start needs to the left and right of it.
MARGIN = 2 * LONG
FULL, OPEN = 1, 2
#: Anchors that a task ranks at a time.
HELD_ROWS = 8_192

_BYTE_NAMES = np.random.default_rng(2024).integers(1, 1 << 63, 256, np.uint64)
_K1, _K2, _S = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(29)


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of the string whose halves have the names a and b."""
    x = a * _K1
    x += b
    x ^= x >> _S
    x *= _K2
    return x


class Chunk:
    """Texts or tiles of texts one after another. ``first``, ``last`` bound the starts of each that are its own."""

    def __init__(self, parts: list[tuple[int, bytes, int, int, int, int]]):
        """(row, bytes, place of the bytes in their text, own starts from, to, length of the text)."""
        self.data = np.frombuffer(b"".join(p[1] for p in parts) + bytes(MARGIN), np.uint8)
        sizes = np.array([len(p[1]) for p in parts])
        begin = np.cumsum(sizes) - sizes
        self.row = np.array([p[0] for p in parts])
        self.shift = begin - np.array([p[2] for p in parts])  # place in the chunk of the text's first byte
        self.end = self.shift + np.array([p[5] for p in parts])
        self.first = self.shift + np.array([p[3] for p in parts])
        self.last = self.shift + np.array([p[4] for p in parts])
        self.begin = begin
        names = _BYTE_NAMES[self.data]
        levels = {1: names}
        for half in (1, 2, 4, 8):
            names = paired(names[:-half], names[half:])
            levels[2 * half] = names
        self.h4, self.h8, self.h16 = levels[4], levels[8], levels[16]
        n = len(self.h16) - 8
        self.gram = paired(self.h16[:n], self.h8[16:16 + n])

    def name32(self, at: np.ndarray) -> np.ndarray:
        return paired(self.h16[at], self.h16[at + 16])

    def name64(self, at: np.ndarray) -> np.ndarray:
        return paired(self.name32(at), self.name32(at + 32))

    def name_long(self, at: np.ndarray) -> np.ndarray:
        return paired(paired(self.name64(at), self.name32(at + 64)), self.h4[at + 96])

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """(own starts of LONG-byte strings, the anchor of each)."""
        n = len(self.gram)
        least = self.gram & np.uint64(0xFFFFFFFF00000000) | np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < SPAN:
            least = np.minimum(least[:width - SPAN], least[SPAN - width:])
        counts = np.maximum(self.last - self.first, 0)
        at = np.repeat(self.first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return at, (np.uint64(0xFFFFFFFF) - (least[at] & np.uint64(0xFFFFFFFF))).astype(np.int64)

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, at, side="right") - 1

    def surroundings(self, anchors: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Name of all bytes that LONG-byte strings with this anchor can hold, as far as the text goes."""
        low, high = anchors - (SPAN - 1), anchors + LONG
        left, right = self.shift[owner], self.end[owner]
        whole = (low >= left) & (high <= right)
        out = np.zeros(len(anchors), np.uint64)
        at = low[whole]
        out[whole] = paired(paired(self.name64(at), self.name64(at + 64)), self.name64(at + (SPAN - 1 + LONG - 64)))
        data = self.data
        for i in np.flatnonzero(~whole).tolist():
            a, b = max(low[i], left[i]), min(high[i], right[i])
            out[i] = xxhash.xxh64_intdigest(data[a:b].tobytes(), seed=int(anchors[i] - a))
        return out


def chunks(rows: Iterator[tuple[int, bytes]]) -> Iterator[Chunk]:
    parts, size = [], 0
    for row, text in rows:
        n = len(text)
        for low in range(0, max(n - LONG + 1, 0), CHUNK_BYTES):
            high = min(low + CHUNK_BYTES, n - LONG + 1)
            a, b = max(0, low - MARGIN), min(n, high + MARGIN)
            parts.append((row, text[a:b], a, low, high, n))
            size += b - a
            if size >= CHUNK_BYTES:
                yield Chunk(parts)
                parts, size = [], 0
    if parts:
        yield Chunk(parts)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for chunk in chunks(enumerate(texts(batch))):
            at, anchor = chunk.starts()
            owner = chunk.owner(at)
            new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
            anchor, owner = anchor[new], owner[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.gram[anchor].view(np.int64)), pa.array(chunk.surroundings(anchor, owner).view(np.int64)),
                 pa.array(ids[chunk.row[owner]]), pa.array((anchor - chunk.shift[owner]).astype(np.int32))],
                ["gram", "around", "doc_id", "at"])


def _classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of gram, around, doc_id, at. The first row of a gram waits until another ``around`` shows up."""
    gram = around = None
    before = waiting = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        g, c, d, p = (batch.column(k).to_numpy() for k in range(4))
        new_gram, new_around, again = np.ones(n, bool), np.ones(n, bool), np.zeros(n, bool)
        new_gram[1:] = g[1:] != g[:-1]
        new_around[1:] = new_gram[1:] | (c[1:] != c[:-1])
        again[1:] = ~new_around[1:] & (d[1:] == d[:-1]) & (p[1:] == p[:-1])
        if gram is not None:
            new_gram[0] = g[0] != gram
            new_around[0] = new_gram[0] or c[0] != around
            again[0] = not new_around[0] and (d[0], p[0]) == before
        gram, around, before = g[-1], c[-1], (d[-1], p[-1])
        full = np.flatnonzero(~new_around & ~again)
        heads = np.flatnonzero(new_around)
        out = [(d[full], p[full], np.full(len(full), FULL, np.int32))]
        if len(heads):
            opens = new_gram[heads]
            if waiting is not None and not opens[0]:
                out.append((np.array([waiting[0]]), np.array([waiting[1]], np.int32), np.array([OPEN], np.int32)))
            waiting = (d[heads[-1]], p[heads[-1]]) if opens[-1] else None
            several = ~opens
            several[:-1] |= ~opens[1:]
            left = heads[several]
            out.append((d[left], p[left], np.full(len(left), OPEN, np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["doc_id", "at", "kind"])


def _of_kind(marks: list, kind: int) -> np.ndarray:
    return np.array([m["at"] for m in marks if m["kind"] == kind], np.int64)


def _marked(chunk: Chunk, at: np.ndarray, anchor: np.ndarray, places: dict[int, np.ndarray]) -> np.ndarray:
    """Which starts have an anchor in their text's ``places``."""
    flags = np.zeros(len(chunk.data), bool)
    for k, row in enumerate(chunk.row.tolist()):
        x = places[row] + chunk.shift[k]
        flags[x[(x >= chunk.begin[k]) & (x < (chunk.begin[k + 1] if k + 1 < len(chunk.begin) else len(chunk.data)))]] = True
    return flags[anchor]


def _arounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open anchors with the bytes that LONG-byte strings over them can hold; ``left`` of them stand before the anchor."""
    for batch in batches:
        ids, grams, sides, rows = batch.column("doc_id").to_pylist(), [], [], ([], [], [])
        for doc_id, marks, text in zip(ids, batch.column("marks").to_pylist(), texts(batch)):
            for at in sorted({m["at"] for m in marks if m["kind"] == OPEN}):
                low = max(0, at - SPAN + 1)
                for column, value in zip(rows, (doc_id, at, at - low)):
                    column.append(value)
                grams.append(xxhash.xxh64_intdigest(text[at:at + GRAM]))
                sides.append(text[low:at + LONG])
        d, p, left = rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(grams, np.uint64).view(np.int64)), pa.array(d, pa.int64()), pa.array(p, pa.int32()), pa.array(left, pa.int32()), pa.array(sides, pa.binary())],
            ["gram", "doc_id", "at", "left", "around"])


def _ranked(rows: list[tuple], hot: bool) -> pa.RecordBatch:
    """``rows`` of whole grams in order: runs of starts whose names came before. Of a hot gram: all starts with their names."""
    gram, doc, at, left, around = zip(*rows)
    chunk = Chunk([(i, x, 0, 0, len(x) - LONG + 1, len(x)) for i, x in enumerate(around)])
    start, anchor = chunk.starts()
    owner = chunk.owner(start)
    mine = anchor == chunk.begin[owner] + np.array(left)[owner]
    start, owner = start[mine], owner[mine]
    name = chunk.name_long(start)
    group = np.array(gram)[owner]
    start = start - chunk.begin[owner] + (np.array(at) - np.array(left))[owner]
    doc = np.array(doc)[owner]
    if hot:
        columns = (name.view(np.int64), group, doc, start, start)
    else:
        order = np.argsort(name, kind="stable")
        same = (name[order[1:]] == name[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
        later = np.zeros(len(name), bool)
        later[order[1:][same]] = True
        k = np.flatnonzero(later)
        goes_on = (owner[k[1:]] == owner[k[:-1]]) & (start[k[1:]] == start[k[:-1]] + 1)
        head = k[np.concatenate(([True], ~goes_on))] if len(k) else k
        tail = k[np.concatenate((~goes_on, [True]))] if len(k) else k
        columns = (None, None, doc[head], start[head], start[tail])
    n = len(columns[2])
    return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns], ["name", "gram", "doc_id", "first", "last"])


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of gram, doc_id, at. A gram with more than HELD_ROWS anchors is handed on, start by start, to a sort."""
    held: list[tuple] = []
    class_from, hot, before = 0, False, None
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if row[:3] == before:
                continue  # a repeated row of the table
            before = row[:3]
            if not held or row[0] != held[-1][0]:
                if hot or len(held) >= HELD_ROWS:
                    yield _ranked(held, hot)
                    held, hot = [], False
                class_from = len(held)
            elif len(held) - class_from >= HELD_ROWS:
                if class_from:
                    yield _ranked(held[:class_from], False)
                yield _ranked(held[class_from:], True)
                held, class_from, hot = [], 0, True
            held.append(row)
    if held:
        yield _ranked(held, hot)


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of name, gram, doc_id, first: those without a name, and all but the first of a name."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        known = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        keys = [batch.column(k).fill_null(0).to_numpy() for k in range(4)]
        same = np.zeros(batch.num_rows, bool)
        same[1:] = (keys[0][1:] == keys[0][:-1]) & (keys[1][1:] == keys[1][:-1]) & ~known[:-1]
        same[0] = last is not None and (keys[0][0], keys[1][0]) == last
        last = None if known[-1] else (keys[0][-1], keys[1][-1])
        found = known | same
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(found)) for k in (2, 3, 4)], ["doc_id", "first", "last"])


def runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and places after the last of the runs of True."""
    edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = list(texts(batch))
        places = {i: _of_kind(m or [], FULL) for i, m in enumerate(batch.column("marks").to_pylist())}
        starts = {i: [np.arange(x["first"], x["last"] + 1) for x in s] for i, s in enumerate(batch.column("starts").to_pylist()) if s}
        for chunk in chunks((i, t) for i, t in enumerate(held) if len(places[i])):
            at, anchor = chunk.starts()
            at = at[_marked(chunk, at, anchor, places)]
            owner = chunk.owner(at)
            edges = np.searchsorted(owner, np.arange(len(chunk.row) + 1))
            for k, row in enumerate(chunk.row.tolist()):
                starts.setdefault(row, []).append(at[edges[k]:edges[k + 1]] - chunk.shift[k])
        first, after = [], []
        for i, text in enumerate(held):
            if i in starts:
                edge = np.zeros(len(text) + 1, np.int32)
                at = np.concatenate(starts[i])
                at = np.unique(at[at + LONG <= len(text)])
                edge[at] += 1
                edge[at + LONG] -= 1
                a, b = runs(np.cumsum(edge[:-1]) > 0)
            else:
                a = b = np.zeros(0, np.int64)
            first.append(a)
            after.append(b)
        spans = [[{"first": int(x), "after": int(y)} for x, y in zip(a, b)] for a, b in zip(first, after)]
        kept = [b"".join(t[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(t)])) for t, a, b in zip(held, first, after)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(map(len, held), pa.int64()), pa.array([int((b - a).sum()) for a, b in zip(first, after)], pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of each row: repeated runs of bytes and the bytes that remain.

    A byte goes if a string of LONG bytes over it also starts earlier, in a smaller
    doc_id or before in the same text; strings are judged on the input. NULL and
    short texts lose nothing. Rows with a NULL doc_id come before all others, in the order
    in which they are written down first, each a document of its own; ids below -2^62 are
    kept for them. Rows equal in doc_id and text are one text and lose the same
    bytes; a doc_id must not name different texts.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    nameless = numbered(docs.where("_id IS NULL"), "doc_id").withColumn("doc_id", F.col("doc_id") - (1 << 62) - (1 << 62))
    docs = docs.where("_id IS NOT NULL").withColumn("doc_id", F.col("_id")).unionByName(nameless)
    order = ["gram", "around", "doc_id", "at"]
    anchors = docs.select("doc_id", "text").mapInArrow(_anchors, "gram long, around long, doc_id long, at int")
    marks = anchors.repartition("gram").sortWithinPartitions(*order).mapInArrow(_classified, "doc_id long, at int, kind int")
    marks = save(marks).groupBy("doc_id").agg(F.collect_list(F.struct("at", "kind")).alias("marks"))
    # Both joins below read the same exchange of the texts.
    dealt = docs.repartition("doc_id")
    open_ = dealt.join(marks.where(F.exists("marks", lambda m: m["kind"] == OPEN)), "doc_id").select("doc_id", "text", "marks")
    around = open_.mapInArrow(_arounds, "gram long, doc_id long, at int, left int, around binary")
    order = ["gram", "doc_id", "at"]
    rows = around.repartition("gram").sortWithinPartitions(*order).mapInArrow(_resolved, "name long, gram long, doc_id long, first long, last long")
    order = ["name", "gram", "doc_id", "first"]
    later = rows.repartition(F.coalesce("name", F.xxhash64("doc_id", "first"))).sortWithinPartitions(*order).mapInArrow(_later, "doc_id long, first long, last long")
    later = later.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("starts"))
    joined = dealt.join(marks, "doc_id", "left").join(later, "doc_id", "left").select("_id", "text", "marks", "starts")
    return joined.mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, spans array<struct<first: long, after: long>>, kept binary")
