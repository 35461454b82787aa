"""Quality rules, extraction, line dedup, licences, decontamination."""

import collections
import math
import random
import re
import tracemalloc
import numpy as np
from llm_helpers import documents
from surveylake.llm import decontamination
from surveylake.llm import quality as q

from surveylake.llm.decontamination import common_subsequence, contaminated, item_words, plain, segments
from surveylake.llm.extraction import extract, main_text
from surveylake.llm.licences import TEMPLATES, scan_licences
from surveylake.llm.lines import dedup_lines, windows, without

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    w = WORD.findall(text)
    seen, again = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            again.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def test_base_counts_are_those_of_brute_force(table):
    for row in table("documents").collect():
        assert q.features(row["text"].encode(), {})[:5] == base_counts(row["text"])


def test_quality_edges(edge, empty, table):
    labels = table("labels")
    rows = q.verdicts(edge, labels).collect()
    assert len(rows) == edge.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 20)
    assert q.verdicts(empty, labels).count() == 0
    kept = q.quality_filter(edge, labels.limit(0))
    assert kept.columns == edge.columns
    assert q.quality_filter(empty, labels).count() == 0


def test_a_cutoff_passes_only_if_the_exact_bound_holds():
    p = q.binomial_below(3, 500, 0.02)
    assert math.isclose(p, sum(math.comb(500, i) * 0.02 ** i * 0.98 ** (500 - i) for i in range(4)), rel_tol=1e-9)
    cutoffs = (0.5, 0.1)
    assert q.choose(cutoffs, [1000, 0, 0], [0, 30, 5], 0.02, 0.01) == 0.1
    assert q.choose(cutoffs, [1000, 0, 0], [0, 0, 5], 0.02, 0.01) == 0.5  # the most lenient of equals
    assert q.choose(cutoffs, [960, 40, 0], [0, 900, 5], 0.02, 0.01) == 0.5  # the strict one rejects 4 %
    assert q.choose(cutoffs, [50, 0, 0], [0, 30, 5], 0.02, 0.01) is None  # too few labels


def test_toxic_texts_go_and_clean_ones_stay(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    texts, marks = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        w = rng.choices(words, k=60)
        if toxic:
            for _k in range(4):
                w[rng.randrange(60)] = rng.choice(("vileone", "vileness", "nastiest", "scumlike"))
        texts.append(" ".join(w))
        marks.append((i, 1, int(toxic)))
    docs, labels = documents(spark, texts), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in q.verdicts(docs, labels).collect()}
    wrong = [sum(kept[i] == bool(t) for i, _q, t in marks if t == kind) for kind in (0, 1)]
    assert wrong[0] <= 0.03 * 1200 and wrong[1] <= 0.05 * 300


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head>
<body><header>Top</header><nav><ul><li><a href=x>Menu</a></ul></nav><!-- no --><div class="ad box">Buy</div>
<div class=cookie-notice>Accept</div><article><h1>Title &amp; more</h1><p>First   <b>bold</b> text,<br>with a break. &eacute;&#33;
<p>Second one, also long enough, I think.</p><p>Ok.</p><aside>Side</aside><form>Send</form></article>
<section id="comments"><p>A comment, with marks, many, of them.</p></section><footer>End</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "Title & more\nFirst bold text, with a break. é!\nSecond one, also long enough, I think.\nOk."
    for page in ("", "<nav>only menu</nav>", "<script>never closed", "<!-- open", "<"):
        assert isinstance(main_text(page), str)
    assert main_text("<nav>only menu</nav>") == ""
    assert main_text("plain &lt;text&gt;") == "plain <text>"


SHORT = "Some words of the story, in short. " * 9
LONG = "A long quotation, with many marks, of one voice: yes, so it is. " * 25


def test_main_text_keeps_all_of_the_article():
    quoted = ["The title"] + [f"{k} {SHORT}".strip() for k in range(6)] + [LONG.strip()]
    inner = f"<h1>{quoted[0]}</h1>" + "".join(f"<p>{x}</p>" for x in quoted[1:7]) + f"<blockquote><p>{LONG}</p></blockquote>"
    for page in (f"<body><nav>Menu</nav><article>{inner}</article>", f"<body><div class=ad>Buy</div><div>{inner}</div>", f"<main>{inner}</main>"):
        assert main_text(page).split("\n") == quoted
    nested = "<article><h1>T</h1><p>Lead</p><div>" + f"<p>{LONG}</p>" * 3 + "<ul><li>one<li>two</ul></div><p>End</p></article>"
    assert main_text(nested).split("\n") == ["T", "Lead", *[LONG.strip()] * 3, "one", "two", "End"]
    assert main_text(nested.replace("article", "section")).split("\n") == ["T", "Lead", *[LONG.strip()] * 3, "one", "two", "End"]
    two = f"<div><article><p>{LONG}</p></article></div><section><article><p>{SHORT}</p></article></section><div>Menu</div>"
    assert main_text(two).split("\n") == [LONG.strip(), SHORT.strip()]
    loose = "<body><div>" + "<div>x</div>" * 60 + f"<div>{SHORT}</div></div><div><section><div>" + f"<p>{LONG}</p>" * 5 + "</div></section></div>"
    assert SHORT.strip() in main_text(loose)


def test_pages_keep_their_rows(spark, table):
    odd = spark.createDataFrame([(1, "u", None, 5), (None, None, "", 5), (1, "u", PAGE * 50, 5)], "page_id long, url string, html string, text int")
    rows = extract(odd).collect()
    assert [r["n_chars"] for r in rows[:2]] == [0, 0] and all(r["n_chars"] == len(r["text"]) for r in rows)
    pages = table("pages")
    assert extract(pages).count() == pages.count()
    assert extract(pages.limit(0)).count() == 0


def repeated_lines(rows, min_words):
    """Every run of consecutive word lines that holds enough words and stood earlier."""
    seen, gone = {}, collections.defaultdict(set)
    for d, text in sorted(rows):
        lines = [x for x in text.split("\n") if x.strip()]
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                run = tuple(lines[i:j + 1])
                if sum(len(x.split()) for x in run) >= min_words:
                    if seen.setdefault(run, (d, i)) < (d, i):
                        gone[d].update(range(i, j + 1))
    return gone


def test_line_dedup_is_brute_force(spark):
    rng = random.Random(3)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 5))) for _ in range(12)] + ["", "  "]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(0, 25))) for _ in range(60)]
    texts += texts[:3]
    want = repeated_lines(list(enumerate(texts)), 8)
    rows = dedup_lines(documents(spark, texts), min_words=8).collect()
    assert {r["doc_id"]: r["_removed"] for r in rows} == {i: len(want[i]) for i in range(len(texts))}
    for r in rows:
        lines = [x for x in texts[r["doc_id"]].split("\n") if x.strip()]
        assert [x for x in r["text"].split("\n") if x.strip()] == [x for k, x in enumerate(lines) if k not in want[r["doc_id"]]]


def test_line_dedup_edges(edge, empty):
    out = dedup_lines(edge).collect()
    assert len(out) == edge.count() and dedup_lines(empty).count() == 0
    assert {r["doc_id"]: r["_removed"] for r in out if r["doc_id"] is not None}[7] > 2_900  # its own repeated lines
    assert [r["text"] for r in out if r["doc_id"] is None].count(None) == 1
    assert windows(b"a b\n\nc", 4) == [] and without(b"\na\nb", [(0, 0)]) == (b"b", 1)


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def test_licence_base_is_brute_force(spark, table, edge, empty):
    texts = [r["text"] for r in table("documents").collect()] + [
        "Released under the MIT License. mit-license; MIT license", "GNU General Public License, version 3",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "permission is free of charge", "cc by nc", "Licensed under CC BY-NC 4.0.", "License " * 500]
    rows = scan_licences(documents(spark, texts)).collect()
    lower = {i: i + 32 for i in range(65, 91)}
    for r in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r["doc_id"]].translate(lower))
        at = [(i, l) for p, l in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        places = [i for i, _l in at]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(at), min(places, default=None), max(places, default=None))
        assert r["base_labels"] == ",".join(sorted({l for _i, l in at})) and 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    labels = {r["doc_id"]: r["labels"] for r in rows}
    n = len(texts) - 7
    assert [labels[n + k] for k in range(7)] == ["mit", "gpl", "mit", "", labels[n + 4], "cc-by-nc", ""]
    assert scan_licences(edge).count() == edge.count() and scan_licences(empty).count() == 0


def test_licences_of_bundles_are_those_of_their_statements(spark):
    whole = [t for _l, t, _p in TEMPLATES]
    texts = whole + ["\n\n".join(whole), "\n".join(whole[::-1] * 20)]
    rows = {r["doc_id"]: r for r in scan_licences(documents(spark, texts)).collect()}
    alone = [set(rows[i]["labels"].split(",")) for i in range(len(whole))]
    assert all(label in found for (label, _t, _p), found in zip(TEMPLATES, alone))
    for i in (len(whole), len(whole) + 1):
        assert set(rows[i]["labels"].split(",")) == set().union(*alone)
    assert all(r["score"] == 1 for r in rows.values())


def test_the_words_that_are_rare_in_the_table_vote(spark):
    """The same text scores by other words where other words are common."""
    def score(others):
        rows = scan_licences(documents(spark, ["released by the mit license"] + [others] * 30)).collect()
        return next(r["score"] for r in rows if r["doc_id"] == 0)

    assert score("under the") == 1  # released, mit and license are rare, and all stand in place
    assert score("license released mit") == 2 / 3  # under, the and license are the rarest; under is missing


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def test_common_subsequence_is_dynamic_programming():
    rng = random.Random(5)
    for _k in range(200):
        a, b = ([bytes([rng.randrange(97, 103)]) for _j in range(rng.randrange(0, 40))] for _i in range(2))
        assert common_subsequence(a, b) == lcs(a, b)
    assert [len(x) for x in segments(list(range(130)))] == [43, 44, 43]


def test_items_and_paraphrases_are_found(spark, table, edge, empty):
    docs, items = table("documents"), table("benchmark")
    bench = [(r["item_id"], r["text"]) for r in items.collect()]
    found = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    whole = {(d, i) for d, t in texts.items() for i, x in bench if x in t}
    assert whole <= found and len(found) <= len(whole) + 2
    words = bench[0][1].split()
    near = " ".join(["filler"] * 50 + [w if k % 9 else "other" for k, w in enumerate(words)] + ["filler"] * 50)
    got = contaminated(documents(spark, [near, "filler " * 200, " ".join(words[:len(words) // 3])]), items).collect()
    assert [r["doc_id"] for r in got if r["item_id"] == bench[0][0]] == [0]
    contaminated(edge, items).collect()
    odd = spark.createDataFrame([(None, "a b"), (1, None), (2, " ")], "item_id long, text string")
    assert contaminated(edge, odd).count() == contaminated(empty, items).count() == 0


def brute_force(texts, bench):
    """(document, item) with enough of the item and its answer in one passage, by the subsequence alone; items of one part."""
    out = set()
    for d, text in enumerate(texts):
        found = [plain(w) for w in text.encode().lower().split()]
        for first in range(0, max(1, len(found) - 64), 32):
            near = found[first:first + 96]
            for i, item in bench:
                w = item_words(item.encode().lower())
                if common_subsequence(w, near) / len(w) >= 0.7 and common_subsequence(w[-6:], near) / len(w[-6:]) >= 0.5:
                    out.add((d, i))
    return out


def test_items_beside_passages_full_of_benchmark_words_are_found(spark):
    rng = random.Random(11)
    lexicon = [f"w{i}" for i in range(900)]
    bench = [(i, " ".join(rng.sample(lexicon, rng.randint(15, 40)))) for i in range(200)]
    texts = []
    for i, item in bench:
        pad = [rng.choice(lexicon)] * 60 if i % 2 else rng.sample(lexicon, 90)
        kept = [w for k, w in enumerate(item.split()) if i % 4 < 2 or k % 5]
        texts.append(" ".join(pad[:40] + kept + pad[40:]))
    want = brute_force(texts, bench)
    assert len(want & {(i, i) for i, _t in bench}) > 190
    got = contaminated(documents(spark, texts), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want


def test_long_items_are_judged_whole(spark):
    rng = random.Random(13)
    lexicon = [f"w{i}" for i in range(5_000)]
    items = [rng.sample(lexicon, 300), rng.sample(lexicon, 70)]
    other = [f"o{i}" for i in range(100)]
    texts, want = [], set()
    for i, w in enumerate(items):
        n = len(w)
        answerless = w[:n * 4 // 5] + other
        changed = [x if k % 6 else "other" for k, x in enumerate(w)]
        for kept, there in ((w[:n // 5], 0), (w[:60 if n > 70 else 35], 0), (answerless, 0), (w[n // 2:], 0), (w, 1), (changed, 1), (w[n // 5:], 1)):
            for lead in (0, 45):
                if there:
                    want.add((len(texts), i))
                texts.append(" ".join(other[:lead] + kept + other))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = contaminated(documents(spark, texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want


def test_the_latent_space_is_fitted_on_all_documents(spark):
    rng = random.Random(17)
    lexicon = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(lexicon, k=rng.choice((0, 20, 150)))) for _k in range(9_000)]
    vocabulary = frozenset(w.encode() for w in lexicon[:200])
    idf = np.zeros(decontamination.FEATURES)
    idf[[decontamination.feature(w) for w in vocabulary]] = 1.5
    basis = np.random.default_rng(1).standard_normal((decontamination.FEATURES, 5))
    want, n = np.zeros(basis.shape), 0
    for text in texts:
        codes = np.array([decontamination.feature(w) if w in vocabulary else -1 for w in text.encode().split()], int)
        for at, weight in decontamination._word_rows(codes, idf):
            want[at] += np.outer(weight, weight @ basis[at])
            n += 1
    columns = "feature int, total binary, rows long"
    parts = documents(spark, texts).select("text").mapInArrow(decontamination._gram(vocabulary, idf.astype(np.float32), basis.astype(np.float32)), columns)
    got, rows = np.zeros(basis.shape), parts.repartition("feature").mapInArrow(decontamination._summed, columns).collect()
    for r in rows:
        got[r["feature"]] = np.frombuffer(r["total"])
    assert sum(r["rows"] for r in rows) == n > 2 * 4_000 and np.allclose(got, want, rtol=1e-3, atol=1e-2)


def paraphrases(seed=23, n=200):
    """Items, and documents that keep the answer and some 60 % of the item in order, the rest replaced; and documents with as much of its frequent words only."""
    rng = random.Random(seed)
    common, lexicon = [f"c{i}" for i in range(30)], [f"w{i}" for i in range(2_500)]
    bench, texts = [], []
    for i in range(n):
        item = [rng.choice(common) if rng.random() < 0.4 else rng.choice(lexicon) for _ in range(rng.randint(18, 40))]
        bench.append((i, " ".join(item)))
        lead = len(item) - 6
        gone = set(rng.sample(range(lead), round(len(item) * 0.4)))
        told = [f"other{rng.randrange(10_000)}" if k in gone else w for k, w in enumerate(item)]
        around = [rng.choice(common) if rng.random() < 0.4 else f"x{rng.randrange(5_000)}" for _ in range(200)]
        at = rng.randrange(100)
        texts.append(" ".join(around[:at] + told + around[at:]))
        plain_ = [w for w in item if w in common]
        texts.append(" ".join(around[:100] + plain_ + around[100:]))
    return bench, texts


def test_paraphrases_are_found_through_the_latent_space(spark, monkeypatch):
    bench, texts = paraphrases()
    docs, items = documents(spark, texts), spark.createDataFrame(bench, "item_id long, text string")
    want = {(2 * i, i) for i, _t in bench}
    literal = brute_force(texts, bench)
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    assert literal <= got and len(got & want) >= 0.9 * len(want)
    # documents with nothing but an item's frequent words stay clean
    assert not {(d, i) for d, i in got - literal if (d, i) not in want}
    monkeypatch.setattr(decontamination, "MIN_COSINE", 2.0)
    without = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()}
    assert without == literal and len(without & want) < 0.2 * len(want)


def test_sums_of_words_hold_no_row_per_word():
    """The sums of runs, long ones too, equal those word by word, in a fraction of the memory of a row per word."""
    rng = np.random.default_rng(3)
    table = rng.integers(-9, 9, (500, 112)).astype(np.float32)  # whole numbers: sums are exact in any order
    at = rng.integers(0, 500, 40_000)
    starts = np.array([0, 1, 33, 65, 66, 9_000, *range(20_000, 39_999, 20)])
    tracemalloc.start()
    found = decontamination.sums_of_runs(table, at, starts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(found, np.add.reduceat(table[at], starts))
    assert peak < table[at].nbytes / 2
