"""Benchmark decontamination by latent semantic retrieval.

Words of the benchmark, weighted by their inverse document frequency over all
documents, are the features. Documents are cut into words once; what is kept of them are the
places of benchmark words. A randomised SVD of the TF-IDF passages of all documents,
from one pass whose sums Spark takes, gives a latent space. Every passage of every document is
compared with every benchmark item there, the items in blocks of bounded size.

A passage can match an item in two ways, and in both the item's answer must stand in it:

- literally: MIN_COMMON of the item's words stand in it in order, by the longest common subsequence.
  Such passages are found whatever their cosine, by enough of the item's rarest words;
- as a paraphrase: its cosine is MIN_COSINE at least, and LATENT_COMMON of the item's words stand in it in
  order, and LATENT_CONTENT of its content words, the rarer half. Only the latent space finds these.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import LOWER, numbered, released, save, texts, unused, words

#: Items that are searched in one pass over the documents; more take more passes.
BLOCK_ITEMS = 4_096
#: Hashed features: bounds the matrix of the SVD.
FEATURES = 1 << 14
RANK, OVERSAMPLE = 96, 16
#: Words that are looked at together.
CHUNK_WORDS = 1 << 16
#: A passage is three strides of words, so items of up to two strides lie in one whole.
STRIDE, STRIDES = 32, 3
MIN_COSINE, LATENT_COMMON, LATENT_CONTENT = 0.6, 0.5, 0.4
MIN_COMMON = 0.7
#: The last words of an item hold its answer.
ANSWER_WORDS, MIN_ANSWER = 6, 0.5
#: Item words that are looked for as one; longer items are cut in equal parts.
SEGMENT = STRIDE * (STRIDES - 1)
#: What may stand around a word.
MARKS = b".,;:!?\"'()[]{}*#$%&|<>-_"
CODED = "doc_id long, n_words long, places binary, codes binary"
ROW = "doc_id long, item_id long, cosine double, common double, answer double, first_word long"


def plain(word: bytes) -> bytes:
    return word.strip(MARKS)


def item_words(text: bytes) -> list[bytes]:
    return [w for w in map(plain, words(text.translate(LOWER))) if w]


def segments(found: list[bytes]) -> list[list[bytes]]:
    parts = max(1, -(-len(found) // SEGMENT))
    edges = [round(k * len(found) / parts) for k in range(parts + 1)]
    return [found[a:b] for a, b in zip(edges, edges[1:])]


def feature(word: bytes) -> int:
    return zlib.crc32(word) % FEATURES


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, a bit per word of ``a``."""
    places: dict[bytes, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for w in b:
        hit = places.get(w)
        if hit:
            both = row & hit
            row = (row + both | row - both) & full
    return len(a) - row.bit_count()


class Codes(dict):
    """Numbers of words in the vocabulary, -1 of others, whatever marks stand around them; words seen are kept up to a bound."""

    KEPT = 400_000

    def __init__(self, vocabulary: dict[bytes, int]):
        self.number = vocabulary.get

    def __missing__(self, word: bytes) -> int:
        code = self[word] = self.number(word.strip(MARKS), -1)
        return code

    def __call__(self, found: list[bytes]) -> np.ndarray:
        if len(self) > self.KEPT:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.int32, len(found))


def sums_of_runs(table: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per run of ``at``, the runs beginning at ``starts``, the sum of its rows of ``table``.

    Runs are cut in pieces of a stride's length, and all pieces are added up side by side, the
    longer ones first, so that no row per entry is held.
    """
    length = np.diff(np.r_[starts, len(at)])
    pieces = -(-length // STRIDE)
    first = pieces.cumsum() - pieces
    begin = np.repeat(starts - first * STRIDE, pieces) + np.arange(pieces.sum()) * STRIDE
    size = np.minimum(np.repeat(starts + length, pieces) - begin, STRIDE)
    order = np.argsort(-size, kind="stable")
    begin = begin[order]
    total = table.take(at[begin], 0)
    for k in range(1, int(size.max(initial=0))):
        longer = np.count_nonzero(size > k)
        total[:longer] += table.take(at[begin[:longer] + k], 0)
    out = np.empty_like(total)
    out[order] = total
    return out if len(out) == len(starts) else np.add.reduceat(out, first)


def _encoded(vocabulary: dict[bytes, int]):
    """Of each document with benchmark words: its number of words, the places of those words and their numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                found = words(text.translate(LOWER))
                coded = codes(found)
                at = np.flatnonzero(coded >= 0)
                if len(at):
                    rows.append((doc_id, len(found), at.astype("<i4").tobytes(), coded[at].astype("<i4").tobytes()))
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_words", "places", "codes"])

    return run


class Chunk:
    """Some documents' benchmark words, put behind each other by strides; a document has three strides at least."""

    def __init__(self, docs: list[tuple]):
        self.docs = docs  # (doc_id, n_words, places, codes)
        strides = np.array([max(STRIDES, -(-n // STRIDE)) for _, n, _, _ in docs])
        real = np.array([max(1, -(-n // STRIDE) - STRIDES + 1) for _, n, _, _ in docs])
        self.base = np.r_[0, strides.cumsum()]
        self.strides = int(self.base[-1])
        #: First strides of all passages; the passages of a document follow each other.
        self.first = np.repeat(self.base[:-1] - np.r_[0, real.cumsum()[:-1]], real) + np.arange(real.sum())
        self.doc = np.repeat(np.arange(len(docs)), real)
        self.stride = np.concatenate([at // STRIDE + b for (_, _, at, _), b in zip(docs, self.base)])
        self.code = np.concatenate([c for _, _, _, c in docs])

    def sums(self, table: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """Per stride, the sum over its words of the rows of their features."""
        out = np.zeros((self.strides, table.shape[1]), table.dtype)
        if len(self.stride):
            starts = np.flatnonzero(np.r_[True, self.stride[1:] != self.stride[:-1]])
            out[self.stride[starts]] = sums_of_runs(table, feature, starts)
        return out

    def passages(self, strides: np.ndarray) -> np.ndarray:
        """Per passage, the sum over its strides."""
        return sum(strides[self.first + k] for k in range(STRIDES))

    def near(self, doc: int, low: int, high: int) -> list[int]:
        """Benchmark words of a document between two places."""
        _, _, at, codes = self.docs[doc]
        return codes[np.searchsorted(at, low):np.searchsorted(at, high)].tolist()


def _chunked(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[Chunk]:
    """Chunks of coded documents, or of texts."""
    held, size = [], 0
    for batch in batches:
        if "text" in batch.schema.names:
            batch = next(_encoded(vocabulary)(iter([pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], ["doc_id", "text"])])))
        for doc_id, n, at, code in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n_words", "places", "codes")]):
            held.append((doc_id, n, np.frombuffer(at, "<i4"), np.frombuffer(code, "<i4")))
            size += n
            if size >= CHUNK_WORDS:
                yield Chunk(held)
                held, size = [], 0
    if held:
        yield Chunk(held)


def whole_item(item: list[int], offset: int, size: int, chunk: Chunk, doc: int, first: int) -> tuple[float, float]:
    """Shares of an item of several parts, and of its answer, in the words around the passage with its part at ``offset``.

    The words around are half as many again as the item has before and after the
    part; the answer is looked for in the passage with most of the item's last part.
    """
    low = max(0, first - (offset * 3 // 2 + STRIDE - 1) // STRIDE * STRIDE)
    high = min(chunk.docs[doc][1], first + STRIDE * STRIDES + (len(item) - offset - size) * 3 // 2)
    common = common_subsequence(item, chunk.near(doc, low, high)) / len(item)
    if common < MIN_COMMON:
        return common, 0.0
    last, answer = segments(item)[-1], item[-ANSWER_WORDS:]
    around = (chunk.near(doc, low + k, min(high, low + k + STRIDE * STRIDES)) for k in range(0, max(1, high - low - STRIDE * (STRIDES - 1)), STRIDE))
    return common, max((common_subsequence(last, x), common_subsequence(answer, x)) for x in around)[1] / len(answer)


def _frequencies(features: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(FEATURES, np.int64)
        for batch in batches:
            for codes in batch.column("codes"):
                counts[np.unique(features[np.frombuffer(codes.as_buffer(), "<i4")])] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["feature", "n"])

    return run


def _word_rows(codes: np.ndarray, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, unit TF-IDF weights) of each passage with any feature."""
    out = []
    count = max(1, -(-len(codes) // STRIDE) - STRIDES + 1)
    for k in range(count):
        part = codes[k * STRIDE:(k + STRIDES) * STRIDE]
        at, n = np.unique(part[part >= 0], return_counts=True)
        weight = n * idf[at]
        norm = np.sqrt((weight ** 2).sum())
        if norm > 0:
            out.append((at, weight / norm))
    return out


def norms(chunk: Chunk, feature: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Length of the TF-IDF vector of each passage, from its strides' vectors and their products with the next two."""
    keys, n = np.unique(feature.astype(np.int64) * chunk.strides + chunk.stride, return_counts=True)
    at, stride = keys // chunk.strides, keys % chunk.strides
    weight = n * idf[at]
    products = []
    for apart in range(STRIDES):
        product = np.zeros(chunk.strides)
        # entries of a feature stand in order of their strides, so one that is ``apart`` strides on is that many entries on at most
        for step in range(min(apart, 1), apart + 1):
            same = at[step:] == at[:len(at) - step]
            left = np.flatnonzero(same & (stride[step:] - stride[:len(at) - step] == apart))
            product += np.bincount(stride[left], weight[left] * weight[left + step], chunk.strides)
        products.append(product)
    squared = sum(products[0][chunk.first + k] for k in range(STRIDES))
    for apart in range(1, STRIDES):
        squared += 2 * sum(products[apart][chunk.first + k] for k in range(STRIDES - apart))
    return np.sqrt(np.maximum(squared, 0))


def _gram(vocabulary, idf: np.ndarray, basis: np.ndarray):
    """Each task's part of (AtA) basis, A the TF-IDF passages, a row per feature; the number of passages is in the first."""
    vocabulary = numbers(vocabulary)
    features = feature_of(vocabulary)
    weighted = idf[:, None] * basis

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(basis.shape, np.float64), 0
        for chunk in _chunked(batches, vocabulary):
            feature = features[chunk.code]
            length = norms(chunk, feature, idf)
            live = length > 0
            rows += int(live.sum())
            image = chunk.passages(chunk.sums(weighted, feature))
            image[live] /= (length[live] ** 2)[:, None]
            image[~live] = 0
            back = np.zeros((chunk.strides, basis.shape[1]), image.dtype)
            for k in range(STRIDES):
                back[chunk.first + k] += image  # no two passages begin with one stride
            order = np.argsort(feature, kind="stable")
            ordered = feature[order]
            starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            total[ordered[starts]] += idf[ordered[starts], None] * sums_of_runs(back, chunk.stride[order], starts)
        at = np.flatnonzero(total.any(1))
        counts = np.zeros(len(at), np.int64)
        counts[:1] = rows
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([total[f].astype(np.float32).tobytes() for f in at], pa.binary()), pa.array(counts)], ["feature", "total", "rows"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per feature: the sums of its parts."""
    sums: dict[int, np.ndarray] = {}
    rows = 0
    for batch in batches:
        for f, part, n in zip(*(batch.column(c).to_pylist() for c in ("feature", "total", "rows"))):
            part = np.frombuffer(part, np.float32).astype(np.float64)
            sums[f] = sums[f] + part if f in sums else part
            rows += n
    counts = [rows] + [0] * len(sums)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary()), pa.array(counts[:len(sums)], pa.int64())], ["feature", "total", "rows"])


def latent_space(docs: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], vocabulary, idf: np.ndarray) -> np.ndarray:
    """FEATURES x RANK right singular vectors of the passages of all documents and the items, which weigh as much as the passages.

    One pass: with B = AtA, W random and Y = B W, the singular vectors are those of Y times the
    inverse root of WtY (Nystroem).
    """
    columns = "feature int, total binary, rows long"
    start = np.random.default_rng(7).standard_normal((FEATURES, RANK + OVERSAMPLE))
    total, rows = np.zeros(start.shape), 0
    parts = docs.mapInArrow(released(_gram(vocabulary, idf.astype(np.float32), start.astype(np.float32))), columns)
    for part in parts.repartition("feature").mapInArrow(released(_summed), columns).collect():  # at most FEATURES rows
        total[part["feature"]] = np.frombuffer(part["total"], np.float64)
        rows += part["rows"]
    scale = max(1.0, rows / max(1, len(items)))
    for at, weight in items:
        total[at] += scale * np.outer(weight, weight @ start[at])
    core = start.T @ total
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    strong = values > max(values.max(), 1e-12) * 1e-7
    return np.linalg.svd(total @ (vectors[:, strong] / np.sqrt(values[strong])), full_matrices=False)[0][:, :RANK]


class RareWords:
    """Exact candidates: the (passage, part) pairs that can hold MIN_COMMON of a part's words.

    A part of n words of which ``need`` must stand in a passage can miss n - need, so
    at least k of any n - need + k of its words stand there. The rarest are taken,
    with a quarter of ``need`` as k.
    """

    def __init__(self, features: list[list[int]], need: list[int], idf: np.ndarray):
        rows, self.least = [], np.array([max(1, n // 4) for n in need])
        for s, part in enumerate(features):
            rare = sorted(part, key=lambda f: -idf[f])[:len(part) - need[s] + self.least[s]]
            rows += [(f, s, rare.count(f)) for f in sorted(set(rare))]
        feature, self.part, self.weight = np.array(sorted(rows), np.int64).reshape(-1, 3).T
        self.count = np.bincount(feature, minlength=FEATURES)
        self.start = np.cumsum(self.count) - self.count
        #: Words at a time, so that about 2^21 postings are looked up at most.
        self.at_once = max(1, (1 << 21) // (STRIDES * max(1, int(self.count.max()))))

    def pairs(self, chunk: Chunk, feature: np.ndarray) -> np.ndarray:
        """passage * parts + part, in order."""
        passage = np.full(chunk.strides, -1)
        passage[chunk.first] = np.arange(len(chunk.first))  # by first stride
        rare = np.flatnonzero(self.count[feature] > 0)
        strides, found, begin = chunk.stride[rare], [np.zeros(0, np.int64)], 0
        while begin < chunk.strides:
            low = int(np.searchsorted(strides, begin))
            if low == len(rare):
                break
            # whole strides, and so many that passages from ``begin`` to ``last`` have all their words here
            upto = int(strides[min(low + self.at_once, len(rare)) - 1])
            upto = max(upto, begin + STRIDES)
            high = int(np.searchsorted(strides, upto + 1))
            last = chunk.strides if high == len(rare) else upto - (STRIDES - 1)
            near = rare[low:high]
            place = chunk.stride[near][:, None] - np.arange(STRIDES)
            inside = (place >= begin) & (place <= last)
            place = np.where(inside, passage[np.clip(place, 0, chunk.strides - 1)], -1)
            seen = place * FEATURES + feature[near][:, None]
            seen = np.unique(seen[place >= 0])
            place, word = seen // FEATURES, seen % FEATURES
            n = self.count[word]
            post = np.arange(n.sum()) + np.repeat(self.start[word] - np.cumsum(n) + n, n)
            keys, back = np.unique(np.repeat(place, n) * len(self.least) + self.part[post], return_inverse=True)
            found.append(keys[np.bincount(back, self.weight[post], len(keys)) >= self.least[keys % len(self.least)]])
            begin = last + 1
        return np.unique(np.concatenate(found))


def _search(table: np.ndarray, latent: np.ndarray, idf: np.ndarray, vocabulary: dict[bytes, int], owners: list, parts: list, wholes: list):
    latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    features = feature_of(vocabulary)
    need = [next(k for k in range(len(part) + 1) if k / len(part) >= MIN_COMMON) for part in parts]
    less = [next(k for k in range(len(part) + 1) if k / len(part) >= LATENT_COMMON) for part in parts]
    rare = RareWords([features[part].tolist() for part in parts], need, idf)
    weights = [idf[features[part]] for part in parts]
    content = [[w for w, x in zip(part, weight) if x >= np.median(weight)] for part, weight in zip(parts, weights)]
    counts = [Counter(part) for part in parts]

    def candidates(chunk: Chunk) -> Iterator[tuple[int, int, float]]:
        """(passage, part, cosine), in order of passages."""
        feature = features[chunk.code]
        vectors = chunk.passages(chunk.sums(table, feature))
        length = np.linalg.norm(vectors, axis=1)
        vectors /= np.maximum(length, 1e-12)[:, None]
        exact = rare.pairs(chunk, feature)
        for low in range(0, len(vectors), 4_096):
            cosine = vectors[low:low + 4_096] @ latent.T
            p, s = np.nonzero(cosine >= MIN_COSINE)
            here = exact[np.searchsorted(exact, low * len(latent)):np.searchsorted(exact, (low + len(cosine)) * len(latent))]
            for key in np.union1d((p + low) * len(latent) + s, here).tolist():
                p, s = divmod(key, len(latent))
                yield p, s, float(cosine[p - low, s])

    def judged(chunk: Chunk, doc: int, first: int, s: int, cosine: float, near: list[int], inside: Counter) -> tuple[float, float]:
        """Shares of the item and of its answer, zero where it is not found."""
        item, offset = wholes[s]
        single = len(item) == len(parts[s])
        latent_ = single and cosine >= MIN_COSINE
        # no subsequence is longer than the item's words that the passage has at all
        if sum(min(n, inside[w]) for w, n in counts[s].items()) < (less if latent_ else need)[s]:
            return 0.0, 0.0
        common = common_subsequence(parts[s], near) / len(parts[s])
        if common < MIN_COMMON and not (
                latent_ and common >= LATENT_COMMON and common_subsequence(content[s], near) >= LATENT_CONTENT * len(content[s])):
            return 0.0, 0.0
        if not single:
            common, share = whole_item(item, offset, len(parts[s]), chunk, doc, first)
            return (common, share) if common >= MIN_COMMON else (0.0, 0.0)
        answer = item[-ANSWER_WORDS:]
        return common, common_subsequence(answer, near) / len(answer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunked(batches, vocabulary):
            best: dict = {}
            here, near, inside = -1, [], Counter()
            for p, s, cosine in candidates(chunk):
                doc = int(chunk.doc[p])
                first = int(chunk.first[p] - chunk.base[doc]) * STRIDE
                if p != here:
                    near = chunk.near(doc, first, first + STRIDE * STRIDES)
                    here, inside = p, Counter(near)
                common, share = judged(chunk, doc, first, s, cosine, near, inside)
                row = (common, share, cosine, -first)
                if common and share >= MIN_ANSWER and best.get((doc, owners[s]), (0,)) < row:
                    best[doc, owners[s]] = row
            out = [(chunk.docs[doc][0], item, cos, common, share, -first) for (doc, item), (common, share, cos, first) in sorted(best.items())]
            columns = list(zip(*out)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "cosine", "common", "answer", "first_word"])

    return run


def numbers(vocabulary) -> dict[bytes, int]:
    """A number per word."""
    return vocabulary if isinstance(vocabulary, dict) else {w: i for i, w in enumerate(sorted(vocabulary))}


def feature_of(vocabulary: dict[bytes, int]) -> np.ndarray:
    """The feature of each word by its number."""
    out = np.zeros(len(vocabulary), np.int64)
    for word, number in vocabulary.items():
        out[number] = feature(word)
    return out


def _block(docs: DataFrame, total: int, items: list[tuple[int, list[bytes]]]) -> DataFrame:
    vocabulary = numbers({w for _, found in items for w in found})
    owners, parts, wholes = [], [], []  # wholes: the words of each part's item, and where the part starts in it
    for item, found in items:
        whole, offset = [vocabulary[w] for w in found], 0
        for part in segments(whole):
            owners.append(item)
            parts.append(part)
            wholes.append((whole, offset))
            offset += len(part)
    features = feature_of(vocabulary)
    coded = save(docs.mapInArrow(released(_encoded(vocabulary)), CODED))
    counts = coded.select("codes").mapInArrow(released(_frequencies(features)), "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    idf = np.zeros(FEATURES)
    idf[features] = np.log(total + 1)
    for row in counts.collect():  # at most FEATURES rows
        idf[row["feature"]] = np.log((total + 1) / (row["n"] + 1))
    idf = np.maximum(idf, 1e-3) * (idf != 0)
    item_features = [features[part] for part in parts]
    rows = [next(iter(_word_rows(np.pad(c, (0, max(0, STRIDE * STRIDES - len(c))), constant_values=-1), idf)), (np.array([], int), np.array([]))) for c in item_features]
    space = latent_space(coded, rows, vocabulary, idf)
    table = (idf[:, None] * space).astype(np.float32)
    latent = np.stack([table[c].sum(0) for c in item_features])
    return coded.mapInArrow(released(_search(table, latent, idf, vocabulary, owners, parts, wholes)), ROW)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer, first_word): each document with each item found in it, at its best passage.

    ``common`` and ``answer`` are the shares of the item's words and of its answer's
    that stand in order in the passage; an item of several parts is found by one of
    them and measured whole over the neighbouring passages, literally only. Items with a NULL id or
    without words and documents without words match nothing; documents with a NULL
    id are searched too; rows that repeat give rows that repeat; an empty benchmark
    or table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = docs.count()
    queries = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct().orderBy("item_id", "text")
    rows = ((r["item_id"], item_words(r["text"].encode())) for r in queries.toLocalIterator())
    rows = (x for x in rows if x[1])
    found = None
    while block := list(islice(rows, BLOCK_ITEMS)):
        more = _block(docs, total, block)
        found = more if found is None else found.unionByName(more)
    return docs.sparkSession.createDataFrame([], ROW) if found is None else found


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which an item was found. A row is known by a number written with it, so ids may be NULL or repeat."""
    row = unused(docs, "_row")
    rows = numbered(docs, row)
    # written first, so that Spark knows its size when it plans the join
    found = save(contaminated(rows.select(F.col(row).alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(row)).distinct())
    return rows.join(found, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
