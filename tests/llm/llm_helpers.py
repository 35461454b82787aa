"""Rows for the tests of the text operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, stratum string, component_id long, shard int, rank int"


def documents(spark, texts, ids=None, lang="en"):
    """Documents with columns whose names clash with those that operators make."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, "s", len(t or ""), "x", 7, 7, 7) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)
