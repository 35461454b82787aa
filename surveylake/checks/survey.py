"""Survey tables built from the given tables: one answer per order.

Every column is text and carries the kinds of dirt a raw file has, so that the
silver layer has something to clean. ``columns`` names the questions wanted; a
join that only serves other questions is not planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from surveylake.plans.silver import build_silver, build_tech
from surveylake.rules import RAW_COLUMNS, TECH_CATEGORIES

# Raw questions a silver column is derived from, where the names differ.
_DERIVED = {
    "edition": ("answered_at",),
    "seniority_rank": ("seniority",),
    "pay_band": ("pay",),
    "n_tools": tuple(TECH_CATEGORIES),
    "issues": RAW_COLUMNS,
}
_PEOPLE = {"role", "region", "state"}
_TOOLS = {"ai_use", *TECH_CATEGORIES}


# Columns read of the given tables; a stated schema saves a look into the files.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sizes are left to Spark: it broadcasts what is under its threshold
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_mktsegment", "r_name", "n_name")
    )


def _tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct choices per order, sorted. A group is reduced to its distinct parts
    (by type, brand and name) before the shuffle, so an order with very many lines stays small."""
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_type", "p_brand",
        "split_part(p_name, ' ', 1) AS first", "split_part(p_name, ' ', 2) AS second",
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.collect_set(F.struct("p_type", "p_brand", "first", "second")).alias("parts"))
        .selectExpr(
            "l_orderkey AS o_orderkey",
            "sort_array(array_distinct(parts.p_type)) AS types",
            "sort_array(array_distinct(parts.p_brand)) AS brands",
            "sort_array(array_distinct(parts.first)) AS firsts",
            "sort_array(array_distinct(parts.second)) AS seconds",
        )
    )


# The dirt rules: what each question holds, from the order and what is joined to it.
_SENIORITY = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Sênior' WHEN '2-HIGH' THEN 'Pleno'
    WHEN '3-MEDIUM' THEN 'Júnior' WHEN '5-LOW' THEN 'Gestor' END"""
_AMOUNT = "translate(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING), '.', ',')"
_MODEL = """CASE o_orderstatus WHEN 'F' THEN 'Presencial' WHEN 'P' THEN 'Híbrido'
    WHEN 'O' THEN 'Remoto' END"""

_QUESTIONS = {
    "resp_id": "CAST(o_orderkey AS STRING)",
    "role": """CASE o_orderkey % 6 WHEN 1 THEN lower(c_mktsegment)
        WHEN 2 THEN concat(' ', c_mktsegment, char(160)) ELSE c_mktsegment END""",
    "region": "r_name",
    "state": "CASE WHEN o_orderkey % 8 = 3 THEN lower(replace(n_name, ' ', '  ')) ELSE n_name END",
    "seniority": f"""CASE
        WHEN o_orderpriority = '4-NOT SPECIFIED' THEN
            CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'N/A' END
        WHEN o_orderkey % 5 = 1 THEN upper({_SENIORITY})
        WHEN o_orderkey % 5 = 2 THEN concat('  ', {_SENIORITY}, ' ')
        WHEN o_orderkey % 5 = 3 THEN translate({_SENIORITY}, 'êú', 'eu')
        ELSE {_SENIORITY} END""",
    "pay": f"""CASE
        WHEN o_orderkey % 101 = 0 THEN '-1,00'
        WHEN o_orderkey % 29 = 0 THEN 'não informado'
        WHEN o_orderkey % 103 = 0 THEN '1234.56'
        WHEN o_orderkey % 107 = 0 THEN '1.2.3'
        WHEN o_orderkey % 109 = 0 THEN '1,239'
        WHEN o_orderkey % 113 = 0 THEN concat('r$', char(160), '1.234,5')
        WHEN o_orderkey % 11 = 0 THEN concat('R$ ', {_AMOUNT})
        ELSE {_AMOUNT} END""",
    "work_model": f"""CASE
        WHEN o_orderkey % 37 = 0 THEN 'outro??'
        WHEN o_orderkey % 4 = 1 THEN lower({_MODEL})
        WHEN o_orderkey % 4 = 2 THEN translate({_MODEL}, 'í', 'i')
        ELSE {_MODEL} END""",
    "answered_at": """CASE
        WHEN o_orderkey % 97 = 0 THEN '31/02/2000'
        ELSE date_format(CAST(o_orderdate AS DATE), 'dd/MM/yyyy') END""",
    "ai_use": """CASE
        WHEN array_contains(types, 'PROMO') THEN
            CASE o_orderkey % 3 WHEN 0 THEN 'Sim' WHEN 1 THEN 'S' ELSE ' sim' END
        WHEN types IS NOT NULL THEN
            CASE o_orderkey % 3 WHEN 0 THEN 'Não' WHEN 1 THEN 'NAO' ELSE 'n' END
        END""",
    "langs": """CASE WHEN o_orderkey % 7 = 1 THEN lower(array_join(types, '; '))
        WHEN o_orderkey % 13 = 5 THEN concat(array_join(types, ';'), '; Não  informado')
        ELSE array_join(types, ';') END""",
    "bi_tools": "array_join(seconds, ';')",
    "databases": "array_join(firsts, ';')",
    "clouds": "array_join(brands, ';')",
}


def survey_raw(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = RAW_COLUMNS
) -> DataFrame:
    wanted = [c for c in _QUESTIONS if c in set(columns)]

    def made(*questions: str) -> list[str]:
        return [f"{_QUESTIONS[c]} AS {c}" for c in questions]

    tools = [c for c in wanted if c in _TOOLS]
    # beside the lists, each question is made before the joins: generated code stays in pieces that the JVM compiles
    alone = [c for c in wanted if c not in _PEOPLE | _TOOLS] if tools else []
    last = {c: f"coalesce({c}, '')" if c in TECH_CATEGORIES else c for c in alone + tools}
    df = table(spark, sf_dir, "orders")
    if tools:
        df = df.selectExpr("o_orderkey", "o_custkey", *made(*alone))
    if _PEOPLE & set(wanted):
        df = df.join(_people(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    if tools:
        df = df.join(_tools(spark, sf_dir).selectExpr("o_orderkey", *made(*tools)), "o_orderkey", "left")
    return df.selectExpr(*[f"{last.get(c, _QUESTIONS[c])} AS {c}" for c in wanted])


def survey_batches(spark: SparkSession, sf_dir: str, columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Two deliveries: the first repeats some answers, the second repeats, changes and un-keys some.

    Each answer gives its one to four copies by itself, so the survey is built once.
    """
    columns = list(dict.fromkeys(["resp_id", "pay", *columns]))
    k = "CAST(resp_id AS BIGINT)"  # made from a number above
    copies = f"""inline(array_compact(array(
        named_struct('_batch_id', 1, '_row_id', 4 * {k}, 'resp_id', resp_id, 'pay', pay),
        CASE WHEN {k} % 70 = 0 THEN named_struct('_batch_id', 1, '_row_id', 4 * {k} + 1, 'resp_id', resp_id, 'pay', '10,00') END,
        CASE WHEN {k} % 50 = 0 THEN named_struct('_batch_id', 2, '_row_id', 4 * {k} + 2, 'resp_id', resp_id,
            'pay', CASE WHEN {k} % 100 = 0 THEN '1000,00' ELSE pay END) END,
        CASE WHEN {k} % 1000 = 7 THEN named_struct('_batch_id', 2, '_row_id', 4 * {k} + 3, 'resp_id', '', 'pay', pay) END
    )))"""
    rest = [c for c in RAW_COLUMNS if c in columns and c not in ("resp_id", "pay")]
    return survey_raw(spark, sf_dir, columns).selectExpr(copies, *rest).select(
        "_batch_id", "_row_id", *[c for c in RAW_COLUMNS if c in columns]
    )


def survey_silver(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    if columns is None:
        return build_silver(survey_raw(spark, sf_dir))
    needed = {r for c in columns for r in _DERIVED.get(c, (c,))}
    raw = survey_raw(spark, sf_dir, [c for c in RAW_COLUMNS if c in needed])
    return build_silver(raw).select(*columns)


def survey_tech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_tech(survey_silver(spark, sf_dir, ["resp_id", *TECH_CATEGORIES]))
