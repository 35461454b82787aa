"""Licence scan by a positional rare-token index, in DataFrame and SQL operations only.

Statements of known licences are templates. A scan keeps, per text, where words of
templates and their mandatory phrases stand. The number of texts that have a word, over the
whole table, says how rare it is; each template is indexed by its rarest words. In texts with a
phrase, each of them looks its template postings up and votes for the place where the
template would start. Places with enough votes whose mandatory phrase stands exactly where
the template has it count. Every template has words of its own that vote, so a
statement's label does not depend on what else is in the file.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.common import save

# Label, statement and mandatory phrase of common licences, in words.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("boost", "distributed under the boost software license version 1 0", "boost software license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "without any express or implied warranty"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "commons attribution noncommercial"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "commons attribution 4 0"),
    ("cc0", "waived all copyright and related or neighboring rights", "copyright and related or neighboring rights"),
)
#: Phrases whose places are counted, with their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: The rarest of a template's distinct words, by the number of texts that have them, vote: this share of them.
RARE_SHARE = 0.5
MIN_VOTES = 2
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = tuple(dict.fromkeys([p for p, _ in BASE] + [p for _, _, p in TEMPLATES]))


def content(words: str, frequency: dict[str, int]) -> list[tuple[str, int]]:
    """A template's rarest words by document frequency, MIN_VOTES of them at least, with their places."""
    found = words.split()
    rarest = sorted(set(found), key=lambda w: (frequency.get(w, 0), w))
    rarest = set(rarest[:max(MIN_VOTES, math.ceil(RARE_SHARE * len(rarest)))])
    return [(w, i) for i, w in enumerate(found) if w in rarest]


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def scan(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, n_words, distinct template words, their places, places of phrases), written once.

    Places of words are kept of texts with a phrase only: no template is verified without its phrase.
    """
    vocabulary = sorted({w for _, t, _ in TEMPLATES for w in t.split()})
    first = {p.split()[0] for p in PHRASES}
    checks = ", ".join(
        f"named_struct('phrase', {k}, 'pos', i, 'there', slice(w, i + 1, {len(p.split())}) = array({_quoted(p.split())}))"
        for k, p in enumerate(PHRASES))
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id",
        F.filter(F.split(lower, SPLIT), lambda x: x != "").alias("w"))
    found = found.withColumn("at", F.expr(f"if(size(w) = 0, array(), filter(sequence(0, size(w) - 1), i -> w[i] IN ({_quoted(sorted({*vocabulary, *first}))})))"))
    found = found.withColumn("phrases", F.expr(f"flatten(transform(filter(at, i -> w[i] IN ({_quoted(sorted(first))})), i -> filter(array({checks}), x -> x.there)))"))
    return save(found.select(
        "_row", "doc_id", F.size("w").cast("long").alias("n_words"),
        F.expr(f"array_distinct(filter(transform(at, i -> w[i]), x -> x IN ({_quoted(vocabulary)})))").alias("words"),
        F.expr(f"if(size(phrases) = 0, array(), transform(filter(at, i -> w[i] IN ({_quoted(vocabulary)})), i -> named_struct('word', w[i], 'pos', i)))").alias("hits"),
        "phrases"))


def document_frequencies(scanned: DataFrame) -> dict[str, int]:
    """The number of texts that have each template word: as many rows as the templates have words."""
    counted = scanned.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counted.collect()}


def _postings(spark: SparkSession, frequency: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Rare template words by position, and each template's label, number of rare words and mandatory phrase: small tables."""
    words, heads = [], []
    for k, (label, text, phrase) in enumerate(TEMPLATES):
        words += [(w, k, i) for w, i in content(text, frequency)]
        start = next(i for i in range(len(text.split())) if text.split()[i:i + len(phrase.split())] == phrase.split())
        heads.append((k, label, len({w for w, _ in content(text, frequency)}), PHRASES.index(phrase), start))
    return (spark.createDataFrame(words, "word string, template int, at int"),
            spark.createDataFrame(heads, "template int, label string, n int, phrase int, start int"))


def template_labels(scanned: DataFrame) -> DataFrame:
    """(_row, labels, score) of rows in which a template was found."""
    postings, heads = _postings(scanned.sparkSession, document_frequencies(scanned))
    hits = scanned.where("size(phrases) > 0").select("_row", F.inline("hits"))
    votes = hits.join(F.broadcast(postings), "word").select(
        "_row", "template", (F.col("pos") - F.col("at")).alias("place"), "word")
    counted = votes.groupBy("_row", "template", "place").agg(F.count_distinct("word").alias("votes")).join(F.broadcast(heads), "template")
    counted = counted.where(F.col("votes") >= F.least(F.lit(MIN_VOTES), "n"))
    there = scanned.select("_row", F.inline("phrases")).select("_row", "phrase", "pos")
    verified = counted.join(there, (counted["_row"] == there["_row"]) & (counted["phrase"] == there["phrase"]) & (F.col("pos") == F.col("place") + F.col("start")), "left_semi")
    return verified.groupBy("_row").agg(F.collect_set("label").alias("more"), F.max(F.col("votes") / F.col("n")).alias("share"))


def scan_licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of each row.

    NULL and empty texts have no words and no labels (empty strings, score 0).
    Repeated rows and NULL ids are rows of their own; other columns are not read.
    The score is the share of a template's rare words that stand in place, at least
    0.5 where a base phrase stands.
    """
    scanned = scan(docs)
    base = F.filter("phrases", lambda x: x["phrase"] < len(BASE))
    labels = F.array_distinct(F.transform(base, lambda x: F.element_at(F.array(*[F.lit(x) for _, x in BASE]), x["phrase"] + 1)))
    found = scanned.select("_row", "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), base["pos"].alias("places"), labels.alias("base"))
    out = found.join(template_labels(scanned), "_row", "left")
    empty = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", "n_base",
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", empty))), ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"))
