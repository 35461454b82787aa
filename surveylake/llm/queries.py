"""The numbered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.collocations import mine
from surveylake.llm.contexts import score_texts
from surveylake.llm.decontamination import contaminated
from surveylake.llm.extraction import extract
from surveylake.llm.licences import scan_licences
from surveylake.llm.lines import dedup_lines
from surveylake.llm.manifest import manifest, verified
from surveylake.llm.minhash import near_duplicate_sets
from surveylake.llm.packing import pack, token_pieces
from surveylake.llm.quality import BASE, RULES, verdicts
from surveylake.llm.sharding import write_shards
from surveylake.llm.simhash import near_duplicates
from surveylake.llm.suffixes import remove_repeats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *BASE, "base_failed", "kept", *[f"score_{r}" for r in RULES])


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op3_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("_removed", "lines_removed")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents"), tokenizer_file()))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = write_shards(table(spark, sf_dir, "documents"), "doc_id", "text", 24)
    return placed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_sets(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = verified(manifest(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_extraction": op2_extraction,
    "op3_contexts": op3_contexts,
    "op4_simhash": op4_simhash,
    "op5_lines": op5_lines,
    "op6_licences": op6_licences,
    "op7_decontamination": op7_decontamination,
    "op8_suffixes": op8_suffixes,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_minhash": op11_minhash,
    "op12_collocations": op12_collocations,
    "op13_manifest": op13_manifest,
}
ORACLE: dict[str, str] = {
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
spelt AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS p
  FROM spelt, (SELECT unnest(range(1, 6)) AS size)),
counted AS (SELECT lang, size, p, count(*) AS f FROM grams GROUP BY lang, size, p HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM spelt GROUP BY lang),
cuts AS (SELECT lang, size, p, f AS a, unnest(range(1, size)) AS k FROM counted WHERE size > 1),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:k]
  JOIN counted y ON y.lang = c.lang AND y.p = c.p[k + 1:c.size]
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (
  SELECT lang, q[i:j] AS p, max(f) AS longer
  FROM (SELECT lang, p AS q, f, size, unnest(range(1, size)) AS i FROM counted WHERE size > 2) s,
       (SELECT unnest(range(2, 6)) AS j) e
  WHERE j > i AND j <= size AND j - i + 1 < size
  GROUP BY ALL),
kept AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.p = b.p
  WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
""",
}
