"""Scores, SimHash, repeated bytes, packing, sharding."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from llm_helpers import documents
from surveylake.llm import contexts, packing, sharding, simhash, suffixes
from surveylake.llm.queries import QUERIES, tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def test_log_gamma():
    x = np.array([0.5, 1.0, 3.5, 100.0, 1e9])
    assert np.allclose(contexts.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12)


def slow_tree(texts, depth, least):
    """P(byte | bytes before) of the same mixture, by recursion over plain dictionaries."""
    counts = collections.defaultdict(collections.Counter)
    for t in texts:
        data = bytes(depth) + t + b"\0"
        for p in range(depth, len(data)):
            for d in range(depth + 1):
                counts[data[p - d:p]][data[p]] += 1
    kept = {c for c, n in counts.items() if n.total() >= least or c == b""}

    def bits(symbols, prefix, size):
        return [sum(n for s, n in symbols.items() if s >> (8 - size) == prefix and s >> (7 - size) & 1 == b) for b in (0, 1)]

    def log_kt(n):
        return math.lgamma(n[0] + .5) + math.lgamma(n[1] + .5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    def below(c, prefix, size):
        children = [k for k in kept if len(k) == len(c) + 1 and k.endswith(c)]
        rest = counts[c].copy()
        for k in children:
            rest.subtract(counts[k])
        return children, bits(rest, prefix, size)

    def log_pw(c, prefix, size):
        own = log_kt(bits(counts[c], prefix, size))
        children, rest = below(c, prefix, size)
        if not children:
            return own
        deep = sum(log_pw(k, prefix, size) for k in children) + log_kt(rest)
        return np.logaddexp(own, deep) - math.log(2)

    def p_one(c, context, prefix, size):
        n = bits(counts[c], prefix, size)
        own = (n[1] + .5) / (sum(n) + 1)
        children, rest = below(c, prefix, size)
        if not children:
            return own
        stop = math.exp(log_kt(n) - math.log(2) - log_pw(c, prefix, size))
        longer = context[len(context) - len(c) - 1:] if len(context) > len(c) else None
        deep = p_one(longer, context, prefix, size) if longer in kept else (rest[1] + .5) / (sum(rest) + 1)
        return stop * own + (1 - stop) * deep

    def score(t):
        data, total = bytes(depth) + t + b"\0", 0.0
        for p in range(depth, len(data)):
            for size in range(8):
                p1 = p_one(b"", data[p - depth:p], data[p] >> (8 - size), size)
                total += math.log10(p1 if data[p] >> (7 - size) & 1 else 1 - p1)
        return total

    return score


def test_tree_is_the_recursive_mixture(spark, monkeypatch):
    texts = ["abab", "abba", "", "aab ab", "bbbb"]
    monkeypatch.setattr(contexts, "SHARE", 0.1)
    docs = documents(spark, texts)
    tree = contexts.fit_tree(docs)
    assert np.allclose(np.exp(tree.log_p.astype(float)).sum(1), 1, atol=1e-4)
    total = sum(len(t) + 1 for t in texts)
    score = slow_tree([t.encode() for t in texts], contexts.DEPTH, max(1, total * 0.1))
    for t in ("ab", "", "ba c"):
        data = np.frombuffer(bytes(contexts.DEPTH) + t.encode() + b"\0", np.uint8)
        assert math.isclose(contexts.log_scores(tree.child, tree.log_p, data, np.array([0]))[0], score(t.encode()), rel_tol=1e-4)


def test_scores(spark, table, small):
    docs = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    tokens = {d: WORD.findall(t.translate(LOWER)) + ["\n"] for d, t in docs.items()}
    out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    count = collections.Counter(w for d, t in tokens.items() if not out[d] for w in t)
    n, v = count.total(), len(count)
    rows = QUERIES["op3_contexts"](spark, small).collect()
    assert len(rows) == len(docs)
    held = [0.0, 0]
    for r in rows:
        t = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[r["doc_id"]], len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        if r["held_out"]:
            held[0] -= r["score"]
            held[1] += len(docs[r["doc_id"]].encode()) + 1
    assert held[0] * math.log2(10) / held[1] < 3.2  # bits per byte of texts that were not learned from


def test_score_edges(edge, empty):
    rows = contexts.score_texts(edge).collect()
    assert len(rows) == edge.count() and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] == 8} == {3}
    assert contexts.score_texts(empty).count() == 0


def fingerprint(text, k):
    w = text.encode().translate(simhash.LOWER).split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, prints, radius):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_pairs_are_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 6, np.uint64)
    prints = np.unique(np.concatenate([base ^ np.uint64(1 << int(a) | 1 << int(b)) for a, b in rng.integers(0, 63, (40, 2))]))
    group = np.sort(rng.integers(0, 3, len(prints)))
    group = np.unique(group[np.argsort(-np.bincount(group)[group], kind="stable")], return_inverse=True)[1]
    order = np.lexsort((group, -np.bincount(group)[group]))
    group = np.unique(group, return_inverse=True)[1]
    for radius in (1, 2, 3):
        a, b = prints[order], group[order]
        got = {(int(x), int(y)) for f, s in simhash.near_pairs(a, b, radius) for x, y in zip(f, s)}
        want = {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if b[i] == b[j] and bin(int(a[i]) ^ int(a[j])).count("1") <= radius}
        assert got == want


@pytest.mark.parametrize("part_rows", [8_192, 3])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, part_rows):
    monkeypatch.setattr(simhash, "PART_ROWS", part_rows)
    rng = random.Random(2)
    prints, chain = [0], rng.getrandbits(64)
    for _k in range(40):
        chain ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
        prints += [chain, rng.getrandbits(64)]
    prints = sorted(set(prints))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in signed], "print long")
    label = {r["u"]: r["label"] for r in simhash.components(simhash.linked(df)).collect()}
    want = groups(sorted(signed), {s: s % (1 << 64) for s in signed}, 3)
    assert {s: label.get(s, s) for s in signed} == want


def test_simhash_query_is_brute_force(spark, table, small):
    docs = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    prints = {d: fingerprint(t, 3) for d, t in docs.items()}
    want = groups(sorted(docs), prints, 3)
    for r in QUERIES["op4_simhash"](spark, small).collect():
        assert (r["fingerprint"], r["component_id"]) == (f"{prints[r['doc_id']]:016x}", want[r["doc_id"]])


def test_simhash_edges(edge, empty):
    rows = simhash.near_duplicates(edge, 3).collect()
    assert len(rows) == edge.count() and simhash.near_duplicates(empty, 3).count() == 0
    assert {r["component_id"] for r in rows if r["print"] == 0} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 5, 10)} == {4}


def without_repeats(rows):
    seen, out = set(), {}
    for d, t in sorted(rows):
        cover = bytearray(len(t))
        for i in range(len(t) - 99):
            if t[i:i + 100] in seen:
                cover[i:i + 100] = b"\1" * 100
            seen.add(t[i:i + 100])
        kept = bytes(x for x, c in zip(t, cover) if not c)
        spans = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        out[d] = (len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("held, chunk", [(8_192, 2 << 20), (3, 700)])
def test_repeats_are_brute_force(spark, monkeypatch, tmp_path, held, chunk):
    monkeypatch.setattr(suffixes, "HELD_ROWS", held)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", chunk)
    rng = random.Random(4)
    pool = ["".join(rng.choices("abé ", k=rng.randint(60, 400))) for _k in range(8)] + ["ab" * 150, "z" * 260]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 6))) + rng.choice(("", "tail", "x" * 99)) for _k in range(60)]
    docs = documents(spark, texts)
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op8_suffixes"](spark, str(tmp_path)).collect()}
    assert got == without_repeats([(i, t.encode()) for i, t in enumerate(texts)])


def test_repeat_edges(edge, empty):
    rows = suffixes.remove_repeats(edge).collect()
    assert len(rows) == edge.count() and suffixes.remove_repeats(empty).count() == 0
    assert {r["doc_id"]: r["n_removed"] for r in rows if r["doc_id"] is not None}[6] == 120_000 - 1
    assert all(r["n_bytes"] == r["n_removed"] + len(r["kept"]) for r in rows)


def test_pieces_are_those_of_the_tokenizer(spark, table):
    from tokenizers import Tokenizer
    direct = Tokenizer.from_file(tokenizer_file())
    texts = [r["text"] for r in table("documents").collect()]
    texts += ["It's 2024's <|endoftext|>x Á é    \x1c\x7f ÄÖ ﬁ 日本語 don'T 'Re", "a<|startoftext|>", "ΑΣ σ", None, ""]
    rows = packing.token_pieces(documents(spark, texts), tokenizer_file(), capacity=64).collect()
    parts = collections.defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append(r)
    for i, t in enumerate(texts):
        ids = np.array(direct.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k, r in enumerate(sorted(parts[i], key=lambda r: r["piece"])):
            part = ids[64 * k:64 * (k + 1)]
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (k, 64 * k, len(part), zlib.crc32(part.tobytes()))
        assert sum(r["length"] for r in parts[i]) == len(ids)


def test_fullest_is_the_best_sum():
    rng = random.Random(6)
    for _k in range(100):
        counts = collections.Counter({rng.randint(1, 30): rng.randint(1, 3) for _j in range(5)})
        room = rng.randint(0, 60)
        sums = {0}
        for x, n in counts.items():
            sums |= {s + x * m for s in sums for m in range(n + 1)}
        chosen = packing.fullest(counts, room)
        assert sum(x * n for x, n in chosen.items()) == max(s for s in sums if s <= room) and all(n <= counts[x] for x, n in chosen.items())


def test_packing_is_gapless_and_tight(spark, small, edge, empty):
    rows = QUERIES["op9_packing"](spark, small).collect()
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.01 * sum(r["length"] for r in rows) / 2048 + 2
    pieces = packing.token_pieces(edge, tokenizer_file())
    assert packing.pack(pieces).count() == pieces.count()
    assert packing.pack(packing.token_pieces(empty, tokenizer_file())).count() == 0


def test_shards(spark, edge, empty):
    docs = documents(spark, [f"text {i % 50}" for i in range(1_000)])
    one, two, other = (sharding.shuffle_into_shards(docs, "doc_id", "text", 7, seed=s, bucket_bytes=2_000) for s in (1, 1, 2))
    places = [{r["doc_id"]: (r["shard"], r["slot"]) for r in x.collect()} for x in (one, two, other)]
    assert places[0] == places[1] != places[2]
    shards = collections.defaultdict(list)
    for shard, slot in places[0].values():
        shards[shard].append(slot)
    assert sorted(map(len, shards.values())) == [142] * 1 + [143] * 6
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    order = [d for _p, d in sorted((p, d) for d, p in places[0].items())]
    assert sum(abs(a - b) < 20 for a, b in zip(order, order[1:])) < 100  # neighbours are strangers
    written = sharding.write_shards(edge, "doc_id", "text", 3)
    assert written.count() == edge.count()
    assert sharding.shuffle_into_shards(empty, "doc_id", "text", 3).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_word_ids_beside_white_space_of_other_alphabets(seed):
    """In every order and mix, the ids of a text are those that the tokenizer gives the whole text."""
    rng = random.Random(seed)
    spaces = ["\u00a0", "\u2028", "\u3000", "\u0085", "\u2003", "\u202f", "\u1680", "\x1c", "\x1f", "\ufeff"]
    pool = ["alpha", "Beta", "\u00e7a", "e\u0301", "\u0301x", "don't", "12", "<|endoftext|>", *spaces, *[f"x{s}y" for s in spaces], *[f"{s}z{s}" for s in spaces]]
    encoder = packing.WordIds(tokenizer_file())
    whole = encoder.whole
    for _ in range(30):
        text = " ".join(rng.choices(pool, k=rng.randrange(1, 40)))
        found = text.encode().split()
        encoder.add(set(found))
        ids = np.frombuffer(b"".join(encoder.words[w] for w in found), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text
