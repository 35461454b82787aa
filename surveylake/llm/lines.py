"""Line dedup by winnowing over line hashes.

A text is its lines with words. From every line starts, and at every line ends, a
shortest window of whole lines that holds MIN_WORDS words. Of each window the line
with the least hash is its fingerprint: equal windows choose the same one, so every
repeated run of that many words is guaranteed to share a fingerprint. Windows are joined by
fingerprint and by the hash of the whole window, which alone would decide; matches are not
extended by comparing lines, but overlapping windows that stood earlier add up to the whole
repeated run, forwards and backwards. All but the earliest occurrence of a run are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.llm.common import boxed, released, save, texts, unboxed, unused

#: A run is deleted only if it holds at least this many words.
MIN_WORDS = 50
#: Windows that a task holds before it hands them on, but for those of one text.
AT_ONCE = 1 << 16
ROW = ["doc_id", "_sum"]


def lines_with_words(text: bytes) -> list[bytes]:
    return [x for x in text.split(b"\n") if x and not x.isspace()]


def window_columns(text: bytes, min_words: int) -> list[np.ndarray]:
    """Fingerprints, window hashes, first lines and last lines of all shortest windows, each once."""
    lines = lines_with_words(text)
    edge = np.concatenate(([0], np.cumsum([len(x.split()) for x in lines], dtype=np.int64)))
    if edge[-1] < max(min_words, 1):
        return [np.zeros(0, t) for t in ("<u8", "<u8", np.int64, np.int64)]
    ends = np.searchsorted(edge, edge[:-1] + min_words) - 1  # last line of the window from each line
    starts = np.searchsorted(edge, edge[1:] - min_words, side="right") - 1  # first line of the window to each line
    at, n = np.arange(len(lines)), len(lines)
    from_line, to_line = ends < n, starts >= 0
    first, last = np.divmod(np.unique(np.concatenate(((at * n + ends)[from_line], (starts * n + at)[to_line]))), n)
    hashes = np.array([xxhash.xxh64_intdigest(x) for x in lines], "<u8")
    least = np.minimum.reduceat(np.append(hashes, hashes[-1]), np.column_stack((first, last + 1)).ravel())[::2]
    raw = hashes.tobytes()
    whole = (xxhash.xxh64_intdigest(raw[8 * i:8 * j + 8]) for i, j in zip(first.tolist(), last.tolist()))
    return [least, np.fromiter(whole, "<u8", len(first)), first, last]


def windows(text: bytes, min_words: int) -> list[tuple[int, int, int, int]]:
    """(fingerprint, window hash, first line, last line) of all shortest windows, each once."""
    return list(zip(*(c.tolist() for c in window_columns(text, min_words))))


def _rows(held: list[tuple[int, int, list[np.ndarray]]]) -> pa.RecordBatch:
    ids, sums, found = zip(*held)
    counts = [len(w[0]) for w in found]
    fp, win, first, last = (np.concatenate(c) for c in zip(*found))
    columns = [np.repeat(np.array(x, np.int64), counts) for x in (ids, sums)]
    columns += [fp.view(np.int64), win.view(np.int64), first.astype(np.int32), last.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*ROW, "fingerprint", "win", "first", "last"])


def _windows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for d, s, text in zip(*(batch.column(c).to_pylist() for c in ROW), texts(batch)):
                found = window_columns(text, min_words)
                if len(found[0]):
                    held.append((d, s, found))
                    n += len(found[0])
                if n >= AT_ONCE:
                    yield _rows(held)
                    held, n = [], 0
            if held:
                yield _rows(held)

    return run


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, _sum, first, last): windows of lines that also stand earlier, by (doc_id, _sum, line)."""
    rows = save(docs.select(*ROW, "text").where("doc_id IS NOT NULL").mapInArrow(
        released(_windows(min_words)), "doc_id long, _sum long, fingerprint long, win long, first int, last int"))
    keys = ["fingerprint", "win"]
    place = F.struct(*ROW, "first")
    known = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(place).alias("earliest")).where("n > 1").select(*keys, "earliest")
    return rows.join(known, keys).where(place > F.col("earliest")).select(*ROW, "first", "last")


def without(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without its word lines in ``spans``, and their number; a line without words goes with the word line before it."""
    gone = {k for first, last in spans for k in range(first, last + 1)}
    kept, at = [], -1
    for line in text.split(b"\n"):
        if line and not line.isspace():
            at += 1
        if at not in gone and not (at < 0 and 0 in gone):
            kept.append(line)
    return b"\n".join(kept), len(gone)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, gone = [], []
        for text, spans in zip(batch.column("text"), batch.column("_spans")):
            text = text.as_py()
            if spans.is_valid:  # row by row: many lines give many spans
                cut, n = without(text.encode(), list(zip(*(spans.values.field(c).to_pylist() for c in ("first", "last")))))
                text = cut.decode()
            else:
                n = 0
            out.append(text)
            gone.append(n)
        columns = [pa.array(out, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names if n != "_spans"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.int64())], [*(n for n in batch.schema.names if n != "_spans"), "_removed"])


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs cut out of ``text`` and their lines counted in ``_removed``.

    The order of occurrences is doc_id, then line. Rows equal in doc_id and text are
    one document and are treated alike; rows with a NULL doc_id have no place in the
    order and stay as they are; NULL and empty texts stay. A text repeated whole
    becomes empty; its row stays. Columns of any name are carried along; where one is
    called ``_removed``, the count gets underscores after its name.
    """
    own = boxed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = _dedup(own, min_words)
    return unboxed(cut, docs, F.col("_removed").alias(unused(docs, "_removed")))


def cut_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without repeated runs and without documents that had nothing else; ``n_chars`` follows the text."""
    cut = dedup_lines(docs, min_words)
    changed = F.col(unused(docs, "_removed")) > 0
    cut = cut.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", length).select(*[F.col(f"`{c}`") for c in docs.columns])


def _dedup(docs: DataFrame, min_words: int) -> DataFrame:
    docs = docs.withColumn("_sum", F.xxhash64("text"))
    spans = repeated_windows(docs.select("doc_id", "_sum", "text"), min_words).distinct()
    spans = spans.groupBy(*ROW).agg(F.collect_list(F.struct("first", "last")).alias("_spans"))
    joined = docs.join(spans.withColumnsRenamed({"doc_id": "_doc"}).withColumnRenamed("_sum", "_sum2"),
                       (F.col("doc_id") == F.col("_doc")) & (F.col("_sum") == F.col("_sum2")), "left").drop("_doc", "_sum", "_sum2")
    kept = [f for f in joined.schema if f.name != "_spans"]
    return joined.mapInArrow(released(_cut), T.StructType([*kept, T.StructField("_removed", T.LongType())]))
