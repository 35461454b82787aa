"""MinHash near-duplicates, phrases, Merkle manifest."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from compare import connect, differences
from llm_helpers import documents
from surveylake.llm import collocations, manifest, minhash
from surveylake.llm.queries import ORACLE, QUERIES
from surveylake.llm.quotient import CountingQuotientFilter, permuted, restored

LOWER = {i: i + 32 for i in range(65, 91)}


# MinHash near-duplicates

def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(zip(found, found[1:])) if len(found) > 1 else frozenset((w,) for w in found)


def slow_components(rows):
    """Of (doc_id, text): the smallest id that links of 0.8 reach."""
    sets = [(i, shingles(t)) for i, t in rows]
    at = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 80 * len(x | y) and at[a] != at[b]:
            at = [at[a] if v == at[b] else v for v in at]
    least = {}
    for label, (i, _) in zip(at, sets):
        if i is not None:
            least[label] = min(least.get(label, i), i)
    return [(i, len(s), least.get(label) if s else i) for label, (i, s) in zip(at, sets)]


def near(rows, **sizes):
    found = minhash.near_duplicate_sets(rows, **sizes).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str)


@pytest.mark.parametrize("small, part", [(64, 512), (2, 5)])
def test_minhash_against_all_pairs(spark, small, part):
    """Chains and families of copies; small bounds send all buckets through the comparison in parts."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for family in range(12):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 8, 60, 150]))
        for _ in range(rng.choice([1, 3, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 1, len(base) // 30, len(base) // 12, len(base) // 8])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    rows = list(enumerate(texts))
    assert near(documents(spark, texts), small=small, part=part) == sorted(slow_components(rows), key=str)


def test_minhash_takes_odd_rows(spark, edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert near(edge) == sorted(slow_components(rows), key=str)
    assert near(empty) == []
    assert near(documents(spark, [None, ""])) == [(0, 0, 0), (1, 0, 1)]


def test_half_keys_collide_as_often_as_sets_overlap():
    rng = np.random.default_rng(3)
    hits = []
    for _ in range(60):
        names = minhash.mixed(rng.integers(0, 1 << 62, 200).astype(np.uint64))
        a, b = minhash.half_keys([names[:180], names[20:]])  # overlap 0.8
        hits.append((a == b).mean())
    assert abs(np.mean(hits) - 0.8 ** minhash.DEPTH) < 0.05


def test_minhash_query(spark, small):
    rows = QUERIES["op11_minhash"](spark, small).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows) == sorted((*x, x[0] == x[2]) for x in slow_components(docs))


# Phrases

def slow_phrases(rows, least, longest, top):
    n, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        hidden = set()
        for p, c in counts.items():
            if c >= least:
                hidden |= {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * c >= 100 * counts[p[i:j]]}
        found = []
        for p, a in counts.items():
            if len(p) > 1 and a >= least and p not in hidden:
                score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -score) for rank, (score, a, p, left, right) in enumerate(found[:top], 1)]
    return sorted(out)


def test_phrases_against_plain_counts(spark):
    rng = random.Random(2)
    texts = [rng.choice("  \t").join(rng.choice(["A", "b", "c", "d e", "é", "fig.", "g,", "h\n", "\x0b", "ab c d"]) for _ in range(300)) for _ in range(9)]
    rows = documents(spark, [*texts, None, "", "a", ".,", texts[0]], lang="xx").unionByName(documents(spark, texts[:3], lang=None))
    want = slow_phrases([(r["lang"], r["text"]) for r in rows.collect()], 3, 5, 150)
    got = collocations.mine(rows.repartition(3), least=3, top=150).collect()
    assert sorted(tuple(r) for r in got) == want and len(want) > 200


def test_phrases_of_many_chunks(spark, monkeypatch):
    """Chunks, cuts inside a text and quotient ranges of a few words."""
    for name, value in (("CHUNK_BYTES", 400), ("CUT_BYTES", 50), ("RANGE_WORDS", 64)):
        monkeypatch.setattr(collocations, name, value)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "b", "c.", "dd", "e"]) for _ in range(400)) for _ in range(4)]
    rows = documents(spark, texts)
    assert sorted(tuple(r) for r in collocations.mine(rows, least=5).collect()) == slow_phrases([("en", t) for t in texts], 5, 5, 2000)


def test_phrases_take_odd_rows(spark, edge, empty):
    rows = [(r["lang"], r["text"]) for r in edge.collect()]
    assert sorted(tuple(r) for r in collocations.mine(edge, least=2).collect()) == slow_phrases(rows, 2, 5, 2000)
    assert collocations.mine(empty).collect() == []


def test_phrases_like_sql(spark, small):
    df = QUERIES["op12_collocations"](spark, small)
    assert differences(df.columns, df.dtypes, [tuple(r) for r in df.collect()], connect(small), ORACLE["op12_collocations"]) == []


@pytest.mark.parametrize("n", [2, 3, 4, 5])
def test_quotient_filter_is_lossless(n):
    rng = np.random.default_rng(n)
    for size, top in ((0, 9), (1, 9), (3, 1 << 32), (5_000, 7), (5_000, 1 << 32)):
        ids = rng.integers(0, top, (n, size), np.uint64)
        assert (restored(permuted(ids)) == ids).all()
        one = CountingQuotientFilter.of(ids)
        again = CountingQuotientFilter.from_bytes(one.to_bytes())
        want = collections.Counter(map(tuple, ids.T.tolist()))
        assert dict(zip(map(tuple, again.ids().T.tolist()), again.counts.tolist())) == want
        if size:
            parts = [p for _, p in one.parts(5)]
            both = CountingQuotientFilter.merged([again, *parts])
            assert (both.limbs == one.limbs).all() and (both.counts == 2 * one.counts).all()


def test_quotient_filter_keeps_large_counts():
    one = CountingQuotientFilter(np.array([[1, 5, 9], [0, 2, 1]], np.uint64), np.array([254, 255, 1 << 40]))
    again = CountingQuotientFilter.from_bytes(one.to_bytes())
    assert again.counts.tolist() == [254, 255, 1 << 40] and (again.limbs == one.limbs).all()


# Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(row, text):
    shown = [None if v is None else str(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in shown])


def slow_tree(leaves):
    """The root, and per leaf the siblings and the place, level by level."""
    paths, level, over = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for k, below in enumerate(over):
            for i in below:
                run = runs[k // 3]
                paths[i].append((run[:k % 3], run[k % 3 + 1:]))
        level = [h(*run) for run in runs]
        over = [sum(over[i:i + 3], []) for i in range(0, len(over), 3)]
    return level[0], paths


def slow_manifest(rows):
    sources = collections.defaultdict(list)
    for r in rows:
        sources[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, slow_leaf(r, r["text"]), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda x: x[:3])
        trees[s] = slow_tree([x[2] for x in sources[s]])
    if not order:
        return []
    root, above = slow_tree([trees[s][0] for s in order])
    out = []
    for s, high in zip(order, above):
        subroot, paths = trees[s]
        for (_, _, leaf, r), low in zip(sources[s], paths):
            path = low + high
            node = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                node = slow_leaf(r, r["text"].replace("\n", ""))
            for before, after in path:
                node = h(*before, node, *after)
            out.append((r["doc_id"], leaf, subroot, root, h(*[x for level in path for side in level for x in side]), node, node == root))
    return sorted(out, key=str)


def proved(docs, **sizes):
    found = manifest.verified(manifest.manifest(docs, **sizes))
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in names) for r in found.collect()), key=str)


def test_manifest_query(spark, small):
    rows = QUERIES["op13_manifest"](spark, small).collect()
    assert sorted(map(tuple, rows), key=str) == slow_manifest(spark.read.parquet(f"{small}/documents.parquet").collect())
    assert {r["verified"] for r in rows} == {True, False}


@pytest.mark.parametrize("height", [0, 1, 2])
def test_manifest_rounds(spark, height):
    """Blocks of 1, 3 and 9 leaves: up to five rounds, sources of every number of leaves up to 30, runs of one included."""
    rows = [(1_000 * s + i, f"s{s}" if s else None, "en", i, f"t\n{i}") for s in (*range(13), 27, 28, 30, 100) for i in range(s or 5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert proved(docs, height=height) == slow_manifest(docs.collect())


def test_manifest_takes_odd_rows(spark, edge, empty):
    assert proved(empty) == []
    got = proved(edge)
    assert got == slow_manifest(edge.collect()) and len(got) == edge.count()
    one = documents(spark, ["a\nb"], [3])
    assert proved(one) == slow_manifest(one.collect())


def test_another_byte_breaks_the_proof(spark):
    row = manifest.manifest(documents(spark, list("abcdefghijk"))).first()
    assert manifest.folded(row["leaf"], row["proof"]) == row["root"]
    assert manifest.folded(h("x"), row["proof"]) != row["root"]
