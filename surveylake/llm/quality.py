"""Quality rules with risk-controlled cutoffs.

Each rule gives a text a score. For every stratum and rule, cutoffs are tried on
labelled holdout rows that pass the base rule, in a fixed order, from lenient to strict. A cutoff passes if
so few good texts score above it that, by the exact binomial law, a true rate of
false rejections over the limit is unlikely; the first that fails ends the row
(fixed-sequence testing, so trying many cutoffs costs nothing). The error level is
divided among all rules and strata (Bonferroni) and the limit among the rules.
Among the cutoffs that passed, the one that catches most bad texts for the good ones
it costs counts, the most lenient of equals. A stratum with too few labels passes none and keeps its texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.llm.common import LOWER, boxed, released, save, texts, unboxed, words

SYMBOLS = b"#*$%&|<>"
UPPER, LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
CONTINUED = bytes(range(0x80, 0xC0))
WINDOW = 8
SHARES = (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02)
#: Rule: label that tells a bad text, cutoffs from lenient to strict.
RULES = {
    "symbols": ("poor", SHARES),
    "capitals": ("poor", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    "toxic": ("toxic", (24.0, 16.0, 12.0, 10.0, 8.0, 6.0, 5.0, 4.0, 3.0, 2.0)),
}
#: At most this share of a stratum's good texts is rejected, all rules together, ...
LIMIT = 0.075
#: ... in all strata at once but for this probability.
ERROR = 0.05
#: Word weights are fitted on a fifth of the labelled rows by hash of the id, at most so many; all others are holdout.
FIT_ROWS = 10_000
#: A word with a weight stands in at least this share of the fitted toxic texts: chance finds of a few copies have none.
FIT_SHARE = 0.02
#: A falsely rejected text weighs as much as so many bad ones caught when cutoffs that passed are compared.
FALSE_COST = 5
#: Words and beginnings with weights, the heaviest.
FIT_WORDS = 2_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(found: list[bytes]) -> int:
    """Words inside some window of eight words that stands in the text twice or more."""
    n = len(found) - WINDOW + 1
    if n < 2:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in found), np.uint64, len(found))
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    window = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        window = window * np.uint64(0xBF58476D1CE4E5B9) + mixed[j:j + n]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(found) + 1, np.int64)
    edge[:n] += again
    edge[WINDOW:] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def stems(text: bytes) -> set[tuple[bytes, ...]]:
    """Each distinct word without marks around it, lower-case: itself and its first 4, 5 and 6 bytes."""
    plain = {w.strip(b".,;:!?\"'()[]{}*#$%&|<>-_") for w in set(words(text.translate(LOWER)))}
    return {(w, w[:4], w[:5], w[:6]) for w in plain if len(w) > 3}


def features(text: bytes, weights: dict[bytes, float]) -> tuple:
    """The five base counts, then a score for each rule; an empty text has zeros."""
    found = words(text)
    n, chars = len(found), sum(map(len, found))
    if not text.isascii():
        chars -= len(text) - len(text.translate(None, CONTINUED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = repeat_words(found)
    letters = len(text) - len(text.translate(None, LETTERS))
    capitals = len(text) - len(text.translate(None, UPPER))
    toxic = math.fsum(max([weights[x] for x in forms if x in weights], default=0.0) for forms in stems(text)) if weights else 0.0
    return (n, chars, symbols, len(lines) - len(set(lines)), repeated,
            symbols / max(chars, 1), capitals / max(letters, 1), toxic)


def _with_features(weights: dict[bytes, float], drop_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t, weights) for t in texts(batch)]
            columns = list(zip(*rows)) or [()] * (len(BASE) + len(RULES))
            made = [pa.array(c, pa.int64() if i < len(BASE) else pa.float64()) for i, c in enumerate(columns)]
            kept = [(batch.column(i), name) for i, name in enumerate(batch.schema.names) if not (drop_text and name == "text")]
            yield pa.RecordBatch.from_arrays(
                [c for c, _ in kept] + made, [n for _, n in kept] + [f"_{c}" for c in (*BASE, *RULES)])

    return run


def with_features(docs: DataFrame, weights: dict[bytes, float], drop_text: bool = False) -> DataFrame:
    """All columns of ``docs`` (but ``text`` if dropped) and the features, their names led by ``_``."""
    kept = [f for f in docs.schema if not (drop_text and f.name == "text")]
    made = [T.StructField(f"_{c}", T.LongType()) for c in BASE] + [T.StructField(f"_{r}", T.DoubleType()) for r in RULES]
    return docs.mapInArrow(released(_with_features(weights, drop_text)), T.StructType(kept + made))


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [sorted({x for forms in stems(t) for x in forms}) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(held, pa.list_(pa.binary()))], ["toxic", "words"])


def word_weights(docs: DataFrame, sample: DataFrame) -> dict[bytes, float]:
    """Log-odds of words and their beginnings for toxic texts, at least 2, from the labelled ``sample`` of at most FIT_ROWS rows."""
    found = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id", "toxic")), "doc_id")
    rows = found.select("toxic", "text").mapInArrow(released(_distinct_words), "toxic int, words array<binary>")
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    totals = sample.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    counts = counts.where(F.col("t") >= max(5, FIT_SHARE * (totals["t"] or 0)))
    weight = F.log((F.col("t") + 0.5) / ((totals["t"] or 0) + 1)) - F.log((F.col("c") + 0.5) / ((totals["c"] or 0) + 1))
    top = counts.select("word", weight.alias("w")).where("w >= 2").orderBy(F.desc("w"), "word").limit(FIT_WORDS)
    return {bytes(r["word"]): r["w"] for r in top.collect()}


def binomial_below(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial in n trials of chance p."""
    total = 0.0
    for i in range(min(k, n) + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    return min(total, 1.0)


def choose(cutoffs: tuple, good: list[int], bad: list[int], limit: float, error: float) -> float | None:
    """``good[i]`` and ``bad[i]``: texts whose score reaches just the i strictest cutoffs."""
    n, best = sum(good), None
    for i, cutoff in zip(range(len(cutoffs), 0, -1), cutoffs):
        false = sum(good[i:])
        if not n or binomial_below(false, n, limit) > error:
            break
        gain = sum(bad[i:]) - FALSE_COST * false
        if best is None or gain > best[0]:
            best = (gain, cutoff)
    return best[1] if best and best[0] > 0 else None


def _chosen(limit: float, error: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cutoffs = RULES[pdf["rule"].iloc[0]][1]
        good, bad = [0] * (len(cutoffs) + 1), [0] * (len(cutoffs) + 1)
        for level, g, b in zip(pdf["level"], pdf["good"], pdf["bad"]):
            good[level], bad[level] = g, b
        cutoff = choose(cutoffs, good, bad, limit, error)
        return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]], "rule": [pdf["rule"].iloc[0]], "cutoff": [math.nan if cutoff is None else cutoff]})

    return run


def _labels(labels: DataFrame) -> DataFrame:
    """One row per labelled document; contradicting rows count as the worse."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.col("quality").cast("int")).alias("quality"), F.max(F.col("toxic").cast("int")).alias("toxic"))


def fit_sample(labels: DataFrame) -> DataFrame:
    fifth = _labels(labels).where(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0)
    return save(fifth.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS))


def _stratum(stratum: str) -> F.Column:
    return F.coalesce(F.col(stratum).cast("string"), F.lit(""))


def _same() -> F.Column:
    return F.md5(F.col("text").cast("binary")).alias("same")


def base_failed() -> F.Column:
    return (F.col("_n_words") < 20) | (100 * F.col("_n_repeat_words") > 30 * F.col("_n_words"))


def cutoffs(scored: DataFrame, labels: DataFrame, sample: DataFrame, stratum: str, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """(stratum, one column per rule): the chosen cutoffs, NULL where none passed. One row per stratum.

    ``scored`` has the features, and in ``same`` a name of the text that equal texts share.
    """
    held = _labels(labels).join(sample.select("doc_id"), "doc_id", "left_anti")
    # The bound holds for independent texts, so a text counts once in its stratum, with its worst label, however often it occurs.
    distinct = scored.where(~base_failed()).join(held, "doc_id").groupBy(_stratum(stratum).alias("stratum"), "same").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"), *[F.first(f"_{r}").alias(f"_{r}") for r in RULES])
    rows = distinct.select(
        "stratum", ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"),
        F.inline(F.array(*[
            F.struct(
                F.lit(rule).alias("rule"),
                sum((F.col(f"_{rule}") >= c).cast("int") for c in levels).alias("level"),
                (F.col("quality") == 0 if label == "poor" else F.col("toxic") == 1).cast("int").alias("bad"))
            for rule, (label, levels) in RULES.items()])))
    counts = save(rows.groupBy("stratum", "rule", "level").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    strata = max(1, counts.select("stratum").distinct().count())
    chosen = counts.groupBy("stratum", "rule").applyInPandas(
        _chosen(limit / len(RULES), error / (len(RULES) * strata)), "stratum string, rule string, cutoff double")
    return save(chosen.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first(F.nanvl("cutoff", F.lit(None).cast("double")))))


def judged(scored: DataFrame, chosen: DataFrame, stratum: str) -> DataFrame:
    """``scored`` with ``_base_failed`` and ``_kept``."""
    chosen = chosen.select(F.col("stratum").alias("_stratum"), *[F.col(r).alias(f"_cut_{r}") for r in RULES])
    failed = base_failed()
    over = [F.coalesce(F.col(f"_{r}") >= F.col(f"_cut_{r}"), F.lit(False)) for r in RULES]
    rejected = failed
    for x in over:
        rejected = rejected | x
    joined = scored.join(chosen, _stratum(stratum) == F.col("_stratum"), "left")
    return joined.withColumn("_base_failed", failed).withColumn("_kept", ~rejected).drop("_stratum", *[f"_cut_{r}" for r in RULES])


def verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, the stratum, base counts, rule scores, base_failed, kept.

    NULL and empty texts have no words and fail the base rule. A NULL stratum is a
    stratum of its own. Rows that repeat a doc_id are judged each; unlabelled or
    NULL ids are judged by the cutoffs of their stratum.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col(f"`{stratum}`").alias("lang"), _same())
    sample = fit_sample(labels)
    scored = save(with_features(docs, word_weights(docs, sample), drop_text=True))
    rows = judged(scored, cutoffs(scored, labels, sample, "lang"), "lang")
    return rows.select("doc_id", F.col("lang").alias(stratum), *[F.col(f"_{c}").alias(c) for c in (*BASE, "base_failed", "kept")], *[F.col(f"_{r}").alias(f"score_{r}") for r in RULES])


def quality_filter(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns, whatever those are called."""
    own = boxed(docs, F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col(f"`{stratum}`").cast("string").alias("lang"), _same())
    sample = fit_sample(labels)
    weights = word_weights(own, sample)
    # features are made once; the labels are joined with those, not with texts
    scored = save(with_features(own, weights))
    chosen = cutoffs(scored.drop("_input", "text"), labels, sample, "lang")
    return unboxed(judged(scored, chosen, "lang").where("_kept"), docs)
