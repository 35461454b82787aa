"""Minimum bin slack packing of token sequences.

The plan needs only how many pieces there are of each length: at most 2,048
counts, whatever the input. Per bin it seeds with the longest piece left, finds by
a bitset subset-sum over the available lengths the fullest feasible combination,
and removes it, as often as the counts allow. Pieces then look their places up by
their rank among the pieces of their length.
"""

from __future__ import annotations

import gc
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveylake.llm.common import LOWER, per_worker, released, save, texts, words

#: Ranks are counted in this many parts per length, so one hot length is no hot task.
RANK_PARTS = 256
#: Words whose ids a worker remembers; it keeps as many of the generation before.
CACHED_WORDS = 500_000
#: Bytes of text that are cut into words at a time.
CHUNK_BYTES = 1 << 20
#: The pieces that the vocabulary's own splitter makes of a normalised text.
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^ \p{L}\p{N}]+"
SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")
#: The splitter's pieces of a printable ASCII word in lower case without apostrophe, and what no such word has.
ASCII_RUNS = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+").findall
SPLIT_APART = re.compile(rb"[^!-~]|'|<\|").search
#: White space of any alphabet; words are split at that of ASCII only.
SPACE = re.compile(r"\s")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordIds:
    """Token ids of words, packed as unsigned 32-bit numbers.

    White space never joins tokens in this vocabulary, so a text's ids are its
    words' ids. New words are normalised, split and encoded many at a time.
    """

    def __init__(self, tokenizer_file: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_file)
        self.merges = Tokenizer(self.whole.model)
        self.split = regex.compile(SPLITTER).findall
        self.character = byte_characters()
        printable = "".join(map(chr, range(33, 127)))
        #: All that the normaliser does to ASCII words is to lower their letters, so they can be split without it.
        self.lowers = self.whole.normalizer.normalize_str(printable) == printable.lower()
        self.words: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def normalised(self, found: list[str]) -> list[str]:
        """Words without white space of any alphabet, normalised together; the normaliser cannot shift them."""
        out = self.whole.normalizer.normalize_str(" ".join(found)).split(" ")
        return out if len(out) == len(found) else [self.whole.normalizer.normalize_str(w) for w in found]

    def cut(self, text: bytes) -> list[bytes]:
        """The words of a text, in lower case where that changes no id: not beside marks that join letters, nor in special tokens."""
        if self.lowers and not any(x in text for x in (b"<|", b"\xcc", b"\xcd")):
            text = text.translate(LOWER)
        return words(text)

    def merged(self, found: list[str], shown: list[str]) -> dict[str, bytes]:
        """The ids of pieces, by the characters that stand for their bytes."""
        coded = self.merges.encode(shown, is_pretokenized=True, add_special_tokens=False)
        raw = np.array(coded.ids, "<u4").tobytes()
        edges = np.searchsorted(np.array(coded.word_ids), np.arange(len(found) + 1)).tolist()
        return dict(zip(found, [raw[4 * a:4 * b] for a, b in zip(edges, edges[1:])]))

    def add(self, found: set[bytes]) -> None:
        """From now on, until the next call, ``words`` has all of ``found``."""
        if len(self.words) > CACHED_WORDS:
            self.old, self.words = self.words, {}
        if len(self.pieces) > CACHED_WORDS:
            self.pieces = {}
        known, old = self.words, self.old
        new = found.difference(known)
        if old:
            known.update([(w, old[w]) for w in new if w in old])
            new = new.difference(known)
        plain, others = [], []
        for word in sorted(new):
            if self.lowers and word.isascii() and not SPLIT_APART(word):
                plain.append(word)
            elif any(x in word for x in SPECIAL) or not word.isascii() and SPACE.search(word.decode()):
                # a special token, or white space that the tokenizer splits at: encoded by itself
                ids = self.whole.encode(word.decode(), add_special_tokens=False).ids
                known[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.append(word)
        if plain:
            runs = [w.lower() if w.isalpha() else ASCII_RUNS(w.lower()) for w in plain]
            unseen = {r for r in runs if r.__class__ is bytes and r not in known}
            unseen.update(p for ps in runs if ps.__class__ is list for p in ps if p not in known)
            shown = [p.decode() for p in sorted(unseen)]
            if shown:
                own = self.merged(shown, shown)
                known.update(zip(map(str.encode, own), own.values()))
            for word, ps in zip(plain, runs):
                known[word] = known[ps] if ps.__class__ is bytes else b"".join([known[p] for p in ps])
        if others:
            parts = [self.split(w) for w in self.normalised([w.decode() for w in others])]
            unseen = list(dict.fromkeys(p for ps in parts for p in ps if p not in self.pieces))
            if unseen:
                shown = [p if p.isascii() and p.isprintable() else "".join([self.character[b] for b in p.encode()]) for p in unseen]
                self.pieces.update(self.merged(unseen, shown))
            pieces = self.pieces
            for word, ps in zip(others, parts):
                known[word] = pieces[ps[0]] if len(ps) == 1 else b"".join([pieces[p] for p in ps])


def cache(tokenizer_file: str) -> str:
    """The name under which a worker keeps the words of a tokenizer."""
    return f"words of {tokenizer_file}"


def _pieces(tokenizer_file: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(cache(tokenizer_file), lambda: WordIds(tokenizer_file))
        end, step = struct.pack("<I", end_id), 4 * capacity

        def pieces(chunk: list[tuple[int, list[bytes]]]) -> pa.RecordBatch:
            out: tuple[list, ...] = ([], [], [], [], [])
            encoder.add(set().union(*[found for _, found in chunk]))
            known = encoder.words
            for doc_id, found in chunk:
                ids = b"".join(map(known.__getitem__, found)) + end
                for piece, start in enumerate(range(0, len(ids), step)):
                    part = ids[start:start + step]
                    for column, value in zip(out, (doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

        gc.disable()  # many small objects are made and none in cycles
        try:
            for batch in batches:
                chunk, size = [], 0
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                    chunk.append((doc_id, encoder.cut(text)))
                    size += len(text)
                    if size >= CHUNK_BYTES:
                        yield pieces(chunk)
                        chunk, size = [], 0
                if chunk:
                    yield pieces(chunk)
        finally:
            gc.enable()

    return run


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: each text's ids and an end id, cut only where longer than ``capacity``. NULL text is empty."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(released(_pieces(tokenizer_file, capacity, end_id), cache(tokenizer_file)), PIECES)


def fullest(counts: Counter, room: int) -> Counter:
    """The multiset of available lengths with the largest sum up to ``room``; longer pieces first among equals."""
    reach, steps = 1, []
    full = (1 << (room + 1)) - 1
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        steps.append((length, reach))
        for _ in range(min(counts[length], room // length)):
            more = (reach | reach << length) & full
            if more == reach:
                break
            reach = more
        if reach >> room & 1:
            break
    best, chosen = reach.bit_length() - 1, Counter()
    for length, before in reversed(steps):
        while not before >> best & 1:
            best -= length
            chosen[length] += 1
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, last rank + 1, copies in a sequence, first sequence, offset of the first copy)."""
    left, used, out, sequence = Counter(counts), Counter(), [], 0
    while left:
        seed = max(left)
        left[seed] -= 1
        pattern = fullest(left, capacity - seed)
        left[seed] += 1
        pattern[seed] += 1
        repeats, offset = min(left[x] // n for x, n in pattern.items()), 0
        for length, copies in sorted(pattern.items(), reverse=True):
            out.append((length, used[length], used[length] + copies * repeats, copies, sequence, offset))
            used[length] += copies * repeats
            left[length] -= copies * repeats
            offset += copies * length
            if not left[length]:
                del left[length]
        sequence += repeats
    return out


def ranked(pieces: DataFrame) -> DataFrame:
    """``rank`` from 0 among the pieces of a length: by part, then by document."""
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_PARTS)).cast("int")
    pieces = pieces.withColumn("_part", part)
    sizes = pieces.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = sizes.select("length", "_part", (F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return pieces.withColumn("_inside", inside).join(before, ["length", "_part"]).withColumn("rank", F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_before")


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths are 1 to ``capacity``.

    Repeated rows, NULL keys and ties are packed like any other piece; no pieces
    give no rows. Only the counts per length reach the driver.
    """
    spark, pieces = pieces.sparkSession, save(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).toLocalIterator()}
    rows = plan(counts, capacity)
    table = spark.createDataFrame(rows, "_length long, _first long, _end long, _copies long, _sequence long, _offset long")
    at = F.col("rank") - F.col("_first")
    fits = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_first")) & (F.col("rank") < F.col("_end"))
    # A few rows per length: the plan has at most some thousands.
    return ranked(pieces).join(F.broadcast(table), fits).select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(at / F.col("_copies"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + at % F.col("_copies") * F.col("length")).cast("long").alias("offset"),
    )
