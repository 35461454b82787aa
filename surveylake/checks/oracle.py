"""The same queries as SQL, written from the rules and run by DuckDB."""

from __future__ import annotations

# --- common tables ------------------------------------------------------------

# survey_raw and what is cleaned from it are stated MATERIALIZED: read in several places
# otherwise, the engine here fails with an internal error.
_RAW = """
tools AS (
  SELECT l_orderkey,
         list_sort(list_distinct(list(p_type))) AS types,
         list_sort(list_distinct(list(p_brand))) AS brands,
         list_sort(list_distinct(list(split_part(p_name, ' ', 1)))) AS firsts,
         list_sort(list_distinct(list(split_part(p_name, ' ', 2)))) AS seconds
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey
),
source AS (
  SELECT o_orderkey AS k, c_mktsegment, r_name, n_name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Sênior' WHEN '2-HIGH' THEN 'Pleno'
              WHEN '3-MEDIUM' THEN 'Júnior' WHEN '5-LOW' THEN 'Gestor' END AS sen,
         replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'Presencial' WHEN 'P' THEN 'Híbrido'
              WHEN 'O' THEN 'Remoto' END AS model,
         strftime(o_orderdate, '%d/%m/%Y') AS day, tools.*
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN tools ON l_orderkey = o_orderkey
),
survey_raw AS MATERIALIZED (
  SELECT CAST(k AS VARCHAR) AS resp_id,
         CASE k % 6 WHEN 1 THEN lower(c_mktsegment) WHEN 2 THEN ' ' || c_mktsegment || chr(160)
              ELSE c_mktsegment END AS role, r_name AS region,
         CASE WHEN k % 8 = 3 THEN lower(replace(n_name, ' ', '  ')) ELSE n_name END AS state,
         CASE WHEN sen IS NULL AND k % 3 = 0 THEN '' WHEN sen IS NULL AND k % 3 = 1 THEN 'N/A'
              WHEN sen IS NULL THEN NULL WHEN k % 5 = 1 THEN upper(sen)
              WHEN k % 5 = 2 THEN '  ' || sen || ' '
              WHEN k % 5 = 3 THEN replace(replace(sen, 'ê', 'e'), 'ú', 'u') ELSE sen END AS seniority,
         CASE WHEN k % 101 = 0 THEN '-1,00' WHEN k % 29 = 0 THEN 'não informado'
              WHEN k % 103 = 0 THEN '1234.56' WHEN k % 107 = 0 THEN '1.2.3' WHEN k % 109 = 0 THEN '1,239'
              WHEN k % 113 = 0 THEN 'r$' || chr(160) || '1.234,5'
              WHEN k % 11 = 0 THEN 'R$ ' || amount ELSE amount END AS pay,
         CASE WHEN k % 37 = 0 THEN 'outro??' WHEN k % 4 = 1 THEN lower(model)
              WHEN k % 4 = 2 THEN replace(model, 'í', 'i') ELSE model END AS work_model,
         CASE WHEN k % 97 = 0 THEN '31/02/2000' ELSE day END AS answered_at,
         CASE WHEN types IS NULL THEN NULL
              WHEN list_contains(types, 'PROMO')
                THEN CASE k % 3 WHEN 0 THEN 'Sim' WHEN 1 THEN 'S' ELSE ' sim' END
              ELSE CASE k % 3 WHEN 0 THEN 'Não' WHEN 1 THEN 'NAO' ELSE 'n' END END AS ai_use,
         COALESCE(CASE WHEN k % 7 = 1 THEN lower(array_to_string(types, '; '))
                       WHEN k % 13 = 5 THEN array_to_string(types, ';') || '; Não  informado'
                       ELSE array_to_string(types, ';') END, '') AS langs,
         COALESCE(array_to_string(seconds, ';'), '') AS bi_tools,
         COALESCE(array_to_string(firsts, ';'), '') AS databases,
         COALESCE(array_to_string(brands, ';'), '') AS clouds
  FROM source
)"""

_MISSING = "('', 'n/a', 'null', 'não informado', 'nao informado', 'sem resposta')"


def _tidy(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[\s\p{{Z}}]+', ' ', 'g'))"


def _key(c: str) -> str:
    return f"lower(strip_accents({_tidy(c)}))"


def _known(c: str) -> str:
    return f"CASE WHEN lower({_tidy(c)}) IN {_MISSING} THEN NULL ELSE {c} END"


def _money(c: str) -> str:
    text = f"upper({_tidy(c)})"
    form = r"[+-]?(R\$ ?)?[+-]?([0-9]+|[0-9]{1,3}(\.[0-9]{3})+)(,[0-9]{1,2})?"
    return (
        f"CASE WHEN regexp_full_match({text}, '{form}') THEN TRY_CAST(replace(replace("
        rf"regexp_replace({text}, 'R\$ ?', ''), '.', ''), ',', '.') AS DECIMAL(12,2)) END"
    )


def _date(c: str) -> str:
    return f"CAST(try_strptime(trim({c}), '%d/%m/%Y') AS DATE)"


def _list(c: str) -> str:
    made = f"list_sort(list_distinct([upper({_tidy("x")}) for x in string_split({c}, ';') if lower({_tidy("x")}) NOT IN {_MISSING}]))"
    return f"CASE WHEN len({made}) > 0 THEN {made} END"


def _seniority(c: str) -> str:
    return (
        f"CASE {_key(c)} WHEN 'junior' THEN 'Júnior' WHEN 'pleno' THEN 'Pleno' "
        "WHEN 'senior' THEN 'Sênior' WHEN 'gestor' THEN 'Gestor' END"
    )


def _rank(c: str) -> str:
    return (
        f"CAST(CASE {_key(c)} WHEN 'junior' THEN 1 WHEN 'pleno' THEN 2 "
        "WHEN 'senior' THEN 3 WHEN 'gestor' THEN 4 END AS BIGINT)"
    )


def _model(c: str) -> str:
    return (
        f"CASE {_key(c)} WHEN 'presencial' THEN 'Presencial' WHEN 'hibrido' THEN 'Híbrido' "
        "WHEN 'remoto' THEN 'Remoto' END"
    )


def _yes(c: str) -> str:
    return (
        f"CASE WHEN {_key(c)} IN ('sim', 's') THEN true WHEN {_key(c)} IN ('nao', 'n') THEN false END"
    )


_CLEAN = f"""
known AS MATERIALIZED (
  SELECT resp_id,
         {", ".join(f"{_known(c)} AS {c}" for c in ("role", "region", "state", "seniority", "pay", "work_model", "answered_at", "ai_use", "langs", "bi_tools", "databases", "clouds"))}
  FROM survey_raw
),
typed AS (
  SELECT TRY_CAST(resp_id AS BIGINT) AS resp_id, {_date("answered_at")} AS answered_at,
         {", ".join(f"upper({_key(c)}) AS {c}" for c in ("role", "region", "state"))},
         {_seniority("seniority")} AS seniority, {_rank("seniority")} AS seniority_rank,
         CASE WHEN {_money("pay")} > 0 THEN {_money("pay")} END AS pay,
         {_model("work_model")} AS work_model, {_yes("ai_use")} AS ai_use,
         {_list("langs")} AS langs, {_list("bi_tools")} AS bi_tools,
         {_list("databases")} AS databases, {_list("clouds")} AS clouds,
         pay AS pay0, answered_at AS date0, work_model AS model0, seniority AS sen0, ai_use AS ai0
  FROM known
),
silver AS (
  SELECT resp_id, CAST(year(answered_at) AS BIGINT) AS edition, answered_at, role, region, state,
         seniority, seniority_rank, pay,
         CASE WHEN pay IS NULL THEN 'sem dado' WHEN pay < 100000 THEN 'A'
              WHEN pay < 300000 THEN 'B' ELSE 'C' END AS pay_band,
         work_model, ai_use, langs, bi_tools, databases, clouds,
         CAST(COALESCE(len(langs), 0) + COALESCE(len(bi_tools), 0) + COALESCE(len(databases), 0)
              + COALESCE(len(clouds), 0) AS BIGINT) AS n_tools,
         [x for x in [
            CASE WHEN pay0 IS NOT NULL AND pay IS NULL THEN 'pay' END,
            CASE WHEN date0 IS NOT NULL AND answered_at IS NULL THEN 'answered_at' END,
            CASE WHEN sen0 IS NOT NULL AND seniority IS NULL THEN 'seniority' END,
            CASE WHEN model0 IS NOT NULL AND work_model IS NULL THEN 'work_model' END,
            CASE WHEN ai0 IS NOT NULL AND ai_use IS NULL THEN 'ai_use' END
         ] if x IS NOT NULL] AS issues
  FROM typed
)"""

_TECH = """
tech AS (
  SELECT resp_id, 'lang' AS category, unnest(langs) AS technology FROM silver
  UNION ALL SELECT resp_id, 'bi', unnest(bi_tools) FROM silver
  UNION ALL SELECT resp_id, 'db', unnest(databases) FROM silver
  UNION ALL SELECT resp_id, 'cloud', unnest(clouds) FROM silver
),
answered AS (
  SELECT resp_id, 'lang' AS category FROM silver WHERE langs IS NOT NULL
  UNION ALL SELECT resp_id, 'bi' FROM silver WHERE bi_tools IS NOT NULL
  UNION ALL SELECT resp_id, 'db' FROM silver WHERE databases IS NOT NULL
  UNION ALL SELECT resp_id, 'cloud' FROM silver WHERE clouds IS NOT NULL
)"""

_BATCHES = """
batches AS (
  SELECT 1 AS _batch_id, CAST(resp_id AS BIGINT) * 4 AS _row_id, resp_id, pay, seniority, ai_use FROM survey_raw
  UNION ALL
  SELECT 1, CAST(resp_id AS BIGINT) * 4 + 1, resp_id, '10,00', seniority, ai_use
  FROM survey_raw WHERE CAST(resp_id AS BIGINT) % 70 = 0
  UNION ALL
  SELECT 2, CAST(resp_id AS BIGINT) * 4 + 2, resp_id, CASE WHEN CAST(resp_id AS BIGINT) % 100 = 0 THEN '1000,00' ELSE pay END,
         seniority, ai_use
  FROM survey_raw WHERE CAST(resp_id AS BIGINT) % 50 = 0
  UNION ALL
  SELECT 2, CAST(resp_id AS BIGINT) * 4 + 3, '', pay, seniority, ai_use FROM survey_raw WHERE CAST(resp_id AS BIGINT) % 1000 = 7
),
latest AS (
  SELECT TRY_CAST(resp_id AS BIGINT) AS resp_id, _batch_id, _row_id, pay, seniority
  FROM batches WHERE TRY_CAST(resp_id AS BIGINT) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(resp_id AS BIGINT) ORDER BY _batch_id DESC, _row_id DESC) = 1
)"""


def _raw(select: str, *more: str) -> str:
    return "WITH " + ",".join([_RAW, *more]) + "\n" + select


def _silver(select: str, *more: str) -> str:
    return _raw(select, _CLEAN, *more)


def _tech(select: str, *more: str) -> str:
    return _silver(select, _TECH, *more)


def _batch(select: str, *more: str) -> str:
    return _raw(select, _BATCHES, *more)


def _pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100 / NULLIF(CAST({whole} AS DOUBLE), 0), 4)"


def _mean(c: str) -> str:
    return f"(CAST(sum({c}) AS DOUBLE) / NULLIF(count({c}), 0))"


def _quantile(c: str, p: float) -> str:
    return f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 4)"


def _crosstab(a: str, b: str, where: str = "true") -> str:
    return _silver(f"""
SELECT {a}, {b}, n,
       {_pct("n", f"sum(n) OVER (PARTITION BY {a})")} AS row_pct,
       {_pct("n", f"sum(n) OVER (PARTITION BY {b})")} AS col_pct,
       {_pct("n", "sum(n) OVER ()")} AS total_pct
FROM (SELECT {a}, {b}, count(*) AS n FROM silver WHERE {where} GROUP BY ALL)""")


def _answered_crosstab(a: str, b: str, where: str = "true") -> str:
    return _crosstab(a, b, f"{where} AND {a} IS NOT NULL AND {b} IS NOT NULL")


def _tech_counts(by: str = "", where: str = "true", last: str = "") -> str:
    keys = f"{by}, " if by else ""
    use = f"USING ({keys}category)"
    return _tech(f"""
SELECT {keys}category, technology, n, base, {_pct("n", "base")} AS pct{last}
FROM (SELECT {keys}category, technology, count(*) AS n
      FROM tech JOIN silver USING (resp_id) WHERE {where} GROUP BY ALL)
JOIN (SELECT {keys}category, count(*) AS base
      FROM answered JOIN silver USING (resp_id) WHERE {where} GROUP BY ALL) {use}""")


def _lift(categories: str) -> str:
    return _tech(f"""
SELECT category, technology, n, hits, base, round(hits / CAST(n AS DOUBLE), 4) AS rate,
       round((hits / CAST(n AS DOUBLE)) / (base_hits / CAST(base AS DOUBLE)), 4) AS lift
FROM (SELECT category, technology, count(*) AS n, count(*) FILTER (ai_use) AS hits
      FROM tech JOIN silver USING (resp_id)
      WHERE ai_use IS NOT NULL AND category IN {categories} GROUP BY ALL)
JOIN (SELECT category, count(*) AS base, count(*) FILTER (ai_use) AS base_hits
      FROM answered JOIN silver USING (resp_id) WHERE ai_use IS NOT NULL GROUP BY ALL) USING (category)""")


def _one_way(dims: tuple, measures: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS value, {measures} FROM silver GROUP BY {d}" for d in dims
    )


_DIMS = ("role", "seniority", "region", "work_model")
_PAID = "count(*) AS n, count(pay) AS paid, CAST(sum(pay) AS DOUBLE) AS pay_sum"

_LISTS = ", ".join(f"array_to_string({c}, ';') AS {c}" for c in ("langs", "bi_tools", "databases", "clouds", "issues"))
_RAW_NAMES = (
    "resp_id", "role", "region", "state", "seniority", "pay", "work_model",
    "answered_at", "ai_use", "langs", "bi_tools", "databases", "clouds",
)


def _profile(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS least, "
        f"CAST(max({c}) AS VARCHAR) AS greatest FROM silver"
    )


# --- one text per query ---------------------------------------------------------

ORACLE: dict[str, str] = {
    "bronze_scan": _raw("SELECT * FROM survey_raw"),
    "silver_trace": _batch(f"""
SELECT l.resp_id, CAST(l._batch_id AS BIGINT) AS _batch_id, l._row_id,
       CAST(CASE WHEN {_money(_known("l.pay"))} > 0 THEN {_money(_known("l.pay"))} END AS DOUBLE) AS pay,
       {_seniority("l.seniority")} AS seniority,
       b.resp_id AS raw_resp_id, b.pay AS raw_pay, b.seniority AS raw_seniority
FROM latest l JOIN batches b ON b._row_id = l._row_id AND b._batch_id = l._batch_id"""),
    "silver_missing_sentinels": _raw(f"""
SELECT resp_id, {", ".join(f"{_known(c)} AS {c}" for c in ("seniority", "pay", "langs"))} FROM survey_raw"""),
    "silver_missing_report": _raw(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({_known(c)}) AS missing, "
            f"round((count(*) - count({_known(c)})) / CAST(count(*) AS DOUBLE), 4) AS share FROM survey_raw"
            for c in _RAW_NAMES
        )
    ),
    "silver_fill_constant": _silver("""
SELECT resp_id, COALESCE(seniority, 'sem resposta') AS seniority, COALESCE(work_model, '?') AS work_model,
       COALESCE(seniority_rank, 0) AS seniority_rank FROM silver"""),
    "silver_drop_missing": _silver("""
SELECT resp_id, seniority, work_model, CAST(pay AS DOUBLE) AS pay
FROM silver WHERE pay IS NOT NULL AND work_model IS NOT NULL"""),
    "silver_impute_median": _silver("""
SELECT resp_id, silver.seniority, CAST(pay AS DOUBLE) AS pay,
       round(COALESCE(CAST(pay AS DOUBLE), m), 4) AS pay_filled
FROM silver LEFT JOIN (SELECT seniority, median(CAST(pay AS DOUBLE)) AS m FROM silver GROUP BY 1) g
  ON g.seniority IS NOT DISTINCT FROM silver.seniority"""),
    "silver_impute_mode": _silver("""
SELECT resp_id, silver.region, work_model, COALESCE(work_model, m) AS work_model_filled
FROM silver LEFT JOIN (
  SELECT region, work_model AS m FROM silver WHERE work_model IS NOT NULL GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, work_model) = 1) g
  ON g.region IS NOT DISTINCT FROM silver.region"""),
    "silver_types_int_bool": _batch(f"""
SELECT CAST(_batch_id AS BIGINT) AS _batch_id, resp_id AS raw_id, TRY_CAST(resp_id AS BIGINT) AS resp_id,
       ai_use AS raw_ai_use, {_yes("ai_use")} AS ai_use FROM batches"""),
    "silver_types_money": _raw(f"""
SELECT resp_id, CAST({_money("pay")} AS DOUBLE) AS pay, pay AS raw_pay,
       CASE WHEN pay IS NOT NULL AND {_money("pay")} IS NULL THEN 'pay' ELSE '' END AS issues
FROM survey_raw"""),
    "silver_types_date": _raw(f"""
SELECT resp_id, CAST({_date("answered_at")} AS VARCHAR) AS answered_at, answered_at AS raw_date,
       CASE WHEN {_date("answered_at")} IS NULL THEN 'answered_at' ELSE '' END AS issues
FROM survey_raw"""),
    "silver_invalid_range": _raw(f"""
SELECT resp_id, CAST(CASE WHEN p > 0 AND p <= 400000 THEN p END AS DOUBLE) AS pay,
       CASE WHEN p <= 0 OR p > 400000 THEN 'pay' ELSE '' END AS issues
FROM (SELECT resp_id, {_money("pay")} AS p FROM survey_raw)"""),
    "silver_clamp": _silver("""
SELECT resp_id, CAST(CASE WHEN pay < 5000 THEN 5000 WHEN pay > 400000 THEN 400000 ELSE pay END AS DOUBLE) AS pay,
       CASE WHEN pay < 5000 OR pay > 400000 THEN 'pay' ELSE '' END AS issues FROM silver"""),
    "silver_invalid_domain": _raw(f"""
SELECT resp_id, CASE WHEN m IN ('presencial', 'hibrido', 'remoto') THEN m END AS work_model,
       CASE WHEN ok THEN answered_at END AS answered_at,
       concat_ws(';', CASE WHEN m NOT IN ('presencial', 'hibrido', 'remoto') THEN 'work_model' END,
                 CASE WHEN NOT ok THEN 'answered_at' END) AS issues
FROM (SELECT resp_id, {_key("work_model")} AS m, answered_at,
             right(answered_at, 4) BETWEEN '1995' AND '2001' AS ok FROM survey_raw)"""),
    "silver_issue_report": _silver("""
SELECT u AS "column", count(*) AS n FROM (SELECT unnest(issues) AS u FROM silver) GROUP BY 1"""),
    "silver_quarantine": _batch("""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) FILTER (k IS NULL) AS BIGINT) AS without_key,
       count(k) AS keys, CAST(sum(n - 1) FILTER (k IS NOT NULL) AS BIGINT) AS repeated,
       count(*) FILTER (k IS NOT NULL AND d > 1) AS differing_keys
FROM (SELECT TRY_CAST(resp_id AS BIGINT) AS k, count(*) AS n, count(DISTINCT pay) AS d FROM batches GROUP BY 1)"""),
    "silver_text_key": _raw(f"""
SELECT resp_id, {_key("seniority")} AS seniority_key, {_key("work_model")} AS work_model_key FROM survey_raw"""),
    "silver_category_map": _raw(f"""
SELECT resp_id, {_seniority("seniority")} AS seniority, seniority AS raw, {_rank("seniority")} AS seniority_rank,
       '' AS issues FROM survey_raw"""),
    "silver_unmapped": _raw(f"""
SELECT work_model, count(*) AS n FROM survey_raw
WHERE {_key("work_model")} NOT IN ('presencial', 'hibrido', 'remoto') GROUP BY 1"""),
    "silver_organise": _raw("""
SELECT state AS uf, region AS regiao, role AS cargo, 'r' || resp_id AS chave FROM survey_raw"""),
    "silver_pay_band": _silver("SELECT resp_id, CAST(pay AS DOUBLE) AS pay, pay_band FROM silver"),
    "silver_aux_columns": _silver("""
SELECT resp_id, CAST(answered_at AS VARCHAR) AS answered_at, seniority,
       array_to_string(langs, ';') AS langs, edition, strftime(answered_at, '%Y-%m') AS month,
       seniority IS NOT NULL AS has_seniority, CAST(COALESCE(len(langs), 0) AS BIGINT) AS n_langs
FROM silver"""),
    "silver_quantile_band": _silver("""
SELECT resp_id, silver.seniority, CAST(pay AS DOUBLE) AS pay,
       CAST(CASE WHEN pay IS NULL THEN NULL WHEN CAST(pay AS DOUBLE) <= q[1] THEN 1
            WHEN CAST(pay AS DOUBLE) <= q[2] THEN 2 WHEN CAST(pay AS DOUBLE) <= q[3] THEN 3
            ELSE 4 END AS BIGINT) AS pay_group
FROM silver LEFT JOIN (
  SELECT seniority, quantile_cont(CAST(pay AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM silver GROUP BY 1) g
  ON g.seniority IS NOT DISTINCT FROM silver.seniority"""),
    "silver_multi_split": _raw(f"""
SELECT resp_id, array_to_string({_list("langs")}, ';') AS langs FROM survey_raw"""),
    "silver_tech_long": _tech("SELECT resp_id, category, technology FROM tech"),
    "silver_dedupe": _batch("""
SELECT CAST(_batch_id AS BIGINT) AS _batch_id, _row_id, resp_id, seniority, pay FROM latest"""),
    "silver_survey": _silver(f"""
SELECT resp_id, edition, CAST(answered_at AS VARCHAR) AS answered_at, role, region, state, seniority,
       seniority_rank, CAST(pay AS DOUBLE) AS pay, pay_band, work_model, ai_use, n_tools, {_LISTS}
FROM silver"""),
    "catalog_profile": _silver(
        "\nUNION ALL ".join(
            _profile(c) for c in ("seniority", "pay", "work_model", "ai_use", "answered_at", "n_tools")
        )
    ),
    "sql_view_query": _silver("""
SELECT work_model, seniority, count(*) AS n, CAST(max(pay) AS DOUBLE) AS max_pay
FROM silver WHERE seniority IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"""),
    "gold_filter": _silver("""
SELECT resp_id, role, work_model, seniority, CAST(pay AS DOUBLE) AS pay FROM silver
WHERE pay BETWEEN 150000 AND 250000 AND work_model IN ('Remoto', 'Híbrido')
  AND seniority IS NOT NULL AND role LIKE '%E%' AND pay <> 200000"""),
    "gold_group": _silver("""
SELECT role, work_model, seniority, count(*) AS n FROM silver GROUP BY ALL HAVING count(*) >= 5"""),
    "gold_aggregates": _silver(f"""
SELECT role, count(*) AS n, count(pay) AS pay_n, round(CAST(sum(pay) AS DOUBLE), 2) AS pay_sum,
       round({_mean("pay")}, 4) AS pay_mean, round(stddev_samp(CAST(pay AS DOUBLE)), 4) AS pay_std,
       CAST(min(pay) AS DOUBLE) AS pay_min, CAST(max(pay) AS DOUBLE) AS pay_max
FROM silver GROUP BY role"""),
    "gold_quantiles": _silver(f"""
SELECT work_model, seniority, count(pay) AS n, round({_mean("pay")}, 4) AS mean,
       {_quantile("pay", 0.05)} AS p05, {_quantile("pay", 0.25)} AS p25, {_quantile("pay", 0.5)} AS p50,
       {_quantile("pay", 0.75)} AS p75, {_quantile("pay", 0.95)} AS p95
FROM silver GROUP BY work_model, seniority"""),
    "gold_quantiles_double": f"""
WITH paid AS (SELECT o_orderstatus, o_orderpriority, o_totalprice * (1.0::DOUBLE - (o_orderkey % 16)::DOUBLE / 64) AS paid FROM orders)
SELECT grouping(o_orderstatus, o_orderpriority) AS level, o_orderstatus, o_orderpriority, count(paid) AS n, round(avg(paid), 4) AS mean,
       {_quantile("paid", 0.01)} AS p01, {_quantile("paid", 0.5)} AS p50, {_quantile("paid", 0.99)} AS p99
FROM paid GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())""",
    "gold_quantiles_bigint": f"""
WITH codes AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN -o_orderkey ELSE o_orderkey END * 6700417 AS code FROM orders)
SELECT o_orderstatus, count(code) AS n, round(sum(code)::DOUBLE / count(code), 4) AS mean,
       {_quantile("code", 0.0)} AS p0, {_quantile("code", 0.1)} AS p10, {_quantile("code", 0.5)} AS p50, {_quantile("code", 1.0)} AS p100
FROM codes GROUP BY o_orderstatus""",
    "gold_distinct": _silver("""
SELECT region, count(*) AS n, count(DISTINCT state) AS state_distinct FROM silver GROUP BY region"""),
    "gold_distinct_sketches": _silver("""
SELECT k AS "column", count(DISTINCT v) FILTER (a) AS first, count(DISTINCT v) FILTER (b) AS second,
       count(DISTINCT v) FILTER (a AND in_b) AS both, count(DISTINCT v) FILTER (a OR b) AS either,
       count(DISTINCT v) FILTER (a AND NOT in_b) AS gone, count(DISTINCT v) FILTER (b AND NOT in_a) AS new
FROM (SELECT *, bool_or(a) OVER (PARTITION BY k, v) AS in_a, bool_or(b) OVER (PARTITION BY k, v) AS in_b
      FROM (SELECT coalesce(edition <= 1994, false) AS a, coalesce(edition >= 1994, false) AS b,
                   unnest(['role', 'region', 'state', 'seniority']) AS k, unnest([role, region, state, seniority]) AS v FROM silver))
GROUP BY k"""),
    "gold_crosstab": _crosstab("seniority", "work_model"),
    "gold_crosstab_wide": _silver("""
SELECT seniority, count(*) FILTER (work_model = 'Presencial') AS presencial,
       count(*) FILTER (work_model = 'Híbrido') AS hibrido,
       count(*) FILTER (work_model = 'Remoto') AS remoto
FROM silver GROUP BY seniority"""),
    "gold_grouping_sets": _silver(f"""
SELECT CAST(grouping(seniority, work_model) AS BIGINT) AS level, seniority, work_model, {_PAID}
FROM silver GROUP BY GROUPING SETS ((seniority), (work_model), ())"""),
    "gold_rollup": _silver(f"""
SELECT CAST(grouping(region, work_model) AS BIGINT) AS level, region, work_model, {_PAID}
FROM silver GROUP BY ROLLUP (region, work_model)"""),
    "gold_cube": _silver(f"""
SELECT CAST(grouping(seniority, work_model) AS BIGINT) AS level, seniority, work_model, {_PAID}
FROM silver GROUP BY CUBE (seniority, work_model)"""),
    "gold_rate": _silver("""
SELECT role, seniority, count(ai_use) AS base, count(*) FILTER (ai_use) AS hits,
       round(avg(CAST(ai_use AS DOUBLE)), 4) AS rate
FROM silver GROUP BY role, seniority HAVING count(ai_use) >= 5"""),
    "gold_index": _silver(f"""
SELECT region, count(pay) AS n, round({_mean("pay")}, 4) AS mean,
       round({_mean("pay")} * 100 / (SELECT {_mean("pay")} FROM silver), 4) AS index,
       round({_mean("pay")} - (SELECT {_mean("pay")} FROM silver), 4) AS gap
FROM silver GROUP BY region"""),
    "gold_cramers_v": _silver("""
, c AS (SELECT seniority, work_model, count(*) AS n FROM silver
        WHERE seniority IS NOT NULL AND work_model IS NOT NULL GROUP BY ALL),
m AS (SELECT seniority, work_model, CAST(n AS DOUBLE) AS n,
             CAST(sum(n) OVER (PARTITION BY seniority) AS DOUBLE) AS a,
             CAST(sum(n) OVER (PARTITION BY work_model) AS DOUBLE) AS b,
             CAST(sum(n) OVER () AS DOUBLE) AS t FROM c),
x AS (SELECT max(t) AS t, sum((n - a * b / t) * (n - a * b / t) / (a * b / t)) AS chi2,
             least(count(DISTINCT seniority), count(DISTINCT work_model)) - 1 AS df FROM m)
SELECT CAST(t AS BIGINT) AS n, round(chi2, 4) AS chi2, round(sqrt(chi2 / (t * df)), 4) AS v FROM x""".lstrip()),
    "gold_correlation": _silver("""
SELECT seniority, count(*) AS n, round(corr(CAST(pay AS DOUBLE), CAST(n_tools AS DOUBLE)), 6) AS corr,
       round(covar_samp(CAST(pay AS DOUBLE), CAST(n_tools AS DOUBLE)), 2) AS covar
FROM silver WHERE pay IS NOT NULL GROUP BY seniority"""),
    "gold_lift": _lift("('bi', 'db')"),
    "gold_top_k": _tech("""
SELECT technology, count(*) AS n FROM tech GROUP BY 1 ORDER BY n DESC, technology LIMIT 10"""),
    "gold_top_k_per_group": _tech("""
SELECT category, technology, n, place FROM (
  SELECT category, technology, count(*) AS n,
         row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, technology) AS place
  FROM tech GROUP BY 1, 2) WHERE place <= 5"""),
    "gold_join_semi": _tech("""
SELECT resp_id, role, work_model FROM silver WHERE EXISTS (
  SELECT 1 FROM tech t WHERE t.resp_id = silver.resp_id AND category = 'lang' AND technology = 'PROMO')"""),
    "gold_join_anti": _tech("""
SELECT resp_id, role, work_model FROM silver WHERE NOT EXISTS (
  SELECT 1 FROM tech t WHERE t.resp_id = silver.resp_id AND category = 'db' AND technology = 'BLUE')"""),
    "gold_join_inner": _tech("""
SELECT s.resp_id, role, work_model, category, technology FROM silver s JOIN tech t ON t.resp_id = s.resp_id"""),
    "gold_join_left": _tech("""
SELECT s.resp_id, role, category, technology
FROM silver s LEFT JOIN (SELECT * FROM tech WHERE category = 'lang') t ON t.resp_id = s.resp_id"""),
    "silver_schema_contract": _raw("""
SELECT CAST(resp_id AS BIGINT) AS resp_id, role, CAST(2 AS BIGINT) AS seniority_rank FROM survey_raw"""),
    "gold_indicator_union": _silver(f"""
SELECT 'mean_pay' AS indicator, region, count(pay) AS base, round({_mean("pay")}, 4) AS value
FROM silver GROUP BY region
UNION ALL SELECT 'ai_rate', region, count(ai_use), round(avg(CAST(ai_use AS DOUBLE)), 4) FROM silver GROUP BY region
UNION ALL SELECT 'remote_rate', region, count(work_model),
       round(avg(CASE WHEN work_model IS NULL THEN NULL WHEN work_model = 'Remoto' THEN 1.0 ELSE 0.0 END), 4)
FROM silver GROUP BY region"""),
    "f1_market_structure": _silver(f"""
SELECT role, edition, n, {_pct("n", "sum(n) OVER (PARTITION BY edition)")} AS pct
FROM (SELECT role, edition, count(*) AS n FROM silver GROUP BY ALL)"""),
    "f1_profile": _silver(f"""
SELECT dimension, value, n, {_pct("n", "sum(n) OVER (PARTITION BY dimension)")} AS pct
FROM ({_one_way(_DIMS, "count(*) AS n")})"""),
    "f1_role_seniority": _answered_crosstab("role", "seniority"),
    "f1_edition_change": _silver(f"""
SELECT role, edition, n, before, n - before AS change, {_pct("(n - before)", "before")} AS change_pct
FROM (SELECT role, edition, n, lag(n) OVER (PARTITION BY role ORDER BY edition) AS before
      FROM (SELECT r.role, e.edition, count(s.edition) AS n
            FROM (SELECT DISTINCT role FROM silver WHERE edition IS NOT NULL) r
            CROSS JOIN (SELECT DISTINCT edition FROM silver WHERE edition IS NOT NULL) e
            LEFT JOIN silver s ON s.edition = e.edition AND s.role IS NOT DISTINCT FROM r.role
            GROUP BY 1, 2))"""),
    "f2_pay_seniority": _silver(f"""
SELECT seniority, count(pay) AS n, round({_mean("pay")}, 4) AS mean,
       {_quantile("pay", 0.25)} AS p25, {_quantile("pay", 0.5)} AS p50, {_quantile("pay", 0.75)} AS p75
FROM silver GROUP BY seniority"""),
    "f2_pay_role_seniority": _silver(f"""
SELECT CAST(grouping(role, seniority) AS BIGINT) AS level, role, seniority, count(pay) AS n,
       round({_mean("pay")}, 4) AS mean,
       {_quantile("pay", 0.25)} AS p25, {_quantile("pay", 0.5)} AS p50, {_quantile("pay", 0.75)} AS p75
FROM silver GROUP BY ROLLUP (role, seniority)"""),
    "f2_pay_band_seniority": _answered_crosstab("pay_band", "seniority", "pay IS NOT NULL"),
    "f2_pay_index": _silver(f"""
SELECT role, seniority, count(pay) AS n, round({_mean("pay")}, 4) AS mean,
       round({_mean("pay")} * 100 / (SELECT {_mean("pay")} FROM silver), 4) AS index,
       round({_mean("pay")} - (SELECT {_mean("pay")} FROM silver), 4) AS gap
FROM silver GROUP BY role, seniority"""),
    "f2_seniority_step": _silver("""
SELECT seniority_rank, seniority, n, round(median, 4) AS median, round(median - below, 4) AS step,
       round((median - below) * 100 / below, 4) AS step_pct
FROM (SELECT *, lag(median) OVER (ORDER BY seniority_rank) AS below FROM (
        SELECT seniority_rank, seniority, count(pay) AS n, median(CAST(pay AS DOUBLE)) AS median
        FROM silver WHERE seniority IS NOT NULL GROUP BY 1, 2))"""),
    "f3_location": _silver(f"""
SELECT CAST(grouping(region, state) AS BIGINT) AS level, region, state, count(*) AS n,
       {_pct("count(*)", "(SELECT count(*) FROM silver)")} AS pct
FROM silver GROUP BY ROLLUP (region, state)"""),
    "f3_seniority_region": _answered_crosstab("region", "seniority"),
    "f3_pay_state": _silver(f"""
SELECT state, count(pay) AS n, round({_mean("pay")}, 4) AS mean,
       {_quantile("pay", 0.25)} AS p25, {_quantile("pay", 0.5)} AS p50, {_quantile("pay", 0.75)} AS p75
FROM silver GROUP BY state"""),
    "f3_work_model_region": _answered_crosstab("region", "work_model"),
    "f3_work_model_role": _answered_crosstab("role", "work_model"),
    "f3_work_model_seniority": _answered_crosstab("seniority", "work_model"),
    "f3_diversity": _silver("""
, c AS (SELECT region, role, count(*) AS n FROM silver WHERE role IS NOT NULL GROUP BY ALL),
p AS (SELECT region, n, n / CAST(sum(n) OVER (PARTITION BY region) AS DOUBLE) AS p FROM c)
SELECT region, CAST(sum(n) AS BIGINT) AS n, count(*) AS labels, round(-sum(p * ln(p)), 4) AS entropy,
       round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) END, 4) AS evenness,
       round(1 - sum(p * p), 4) AS simpson
FROM p GROUP BY region""".lstrip()),
    "f3_pay_region_model": _silver("""
SELECT region, work_model, n, round(median, 4) AS median, round(best, 4) AS best,
       round(median - best, 4) AS gap, round((median - best) * 100 / best, 4) AS gap_pct
FROM (SELECT *, max(median) OVER (PARTITION BY region) AS best FROM (
        SELECT region, work_model, count(pay) AS n, median(CAST(pay AS DOUBLE)) AS median
        FROM silver WHERE work_model IS NOT NULL GROUP BY 1, 2))"""),
    "f4_adoption": _tech_counts(),
    "f4_top_tech": _tech_counts(
        last=", row_number() OVER (PARTITION BY category ORDER BY n DESC, technology) AS place"
    ) + " QUALIFY place <= 3",
    "f4_top_tech_region": _tech_counts(
        "region",
        last=", row_number() OVER (PARTITION BY region, category ORDER BY n DESC, technology) AS place",
    ) + " QUALIFY place <= 3",
    "f4_tech_seniority": _tech_counts("seniority", "seniority IS NOT NULL"),
    "f4_tech_role": _tech_counts("role"),
    "f4_tech_work_model": _tech_counts("work_model", "work_model IS NOT NULL"),
    "f4_tech_state": _tech_counts("state"),
    "f4_maturity": _silver("""
SELECT seniority, count(*) AS n, round(avg(CAST(n_tools AS DOUBLE)), 4) AS mean_tools,
       round(avg(CAST((langs IS NOT NULL)::INT + (bi_tools IS NOT NULL)::INT
             + (databases IS NOT NULL)::INT + (clouds IS NOT NULL)::INT AS DOUBLE)), 4) AS mean_categories
FROM silver GROUP BY seniority"""),
    "f4_tech_pairs": _tech("""
, t AS (SELECT resp_id, category || ':' || technology AS t FROM tech),
s AS (SELECT t, count(*) AS n FROM t GROUP BY 1),
b AS (SELECT CAST(count(DISTINCT resp_id) AS DOUBLE) AS base FROM t),
p AS (SELECT x.t AS a, y.t AS b, count(*) AS n FROM t x JOIN t y ON x.resp_id = y.resp_id AND x.t < y.t GROUP BY 1, 2)
SELECT p.a, p.b, p.n, round(p.n / base, 4) AS support, round(p.n * base / sa.n / sb.n, 4) AS lift
FROM p JOIN s sa ON sa.t = p.a JOIN s sb ON sb.t = p.b, b""".lstrip()),
    "f4_pay_tech": _tech(f"""
SELECT category, technology, n, round(mean, 4) AS mean, round(median, 4) AS median,
       round(mean * 100 / overall, 4) AS index
FROM (SELECT category, technology, count(pay) AS n, {_mean("pay")} AS mean,
             median(CAST(pay AS DOUBLE)) AS median
      FROM tech JOIN silver USING (resp_id) WHERE pay IS NOT NULL GROUP BY 1, 2)
JOIN (SELECT category, {_mean("pay")} AS overall FROM answered JOIN silver USING (resp_id) GROUP BY 1)
  USING (category)"""),
    "f5_ai_rate": _silver(_one_way(_DIMS, """count(ai_use) AS base, count(*) FILTER (ai_use) AS hits,
  round(avg(CAST(ai_use AS DOUBLE)), 4) AS rate""")),
    "f5_ai_state": _silver("""
SELECT state, count(ai_use) AS base, count(*) FILTER (ai_use) AS hits, round(avg(CAST(ai_use AS DOUBLE)), 4) AS rate
FROM silver GROUP BY state"""),
    "f5_ai_pay": _silver("""
SELECT seniority, n_with, n_without, round(w, 4) AS median_with, round(wo, 4) AS median_without,
       round(w - wo, 4) AS gap, round((w - wo) * 100 / wo, 4) AS gap_pct
FROM (SELECT seniority, count(*) FILTER (ai_use) AS n_with, count(*) FILTER (NOT ai_use) AS n_without,
             median(CAST(pay AS DOUBLE)) FILTER (ai_use) AS w,
             median(CAST(pay AS DOUBLE)) FILTER (NOT ai_use) AS wo
      FROM silver WHERE ai_use IS NOT NULL AND pay IS NOT NULL GROUP BY 1)"""),
    "f5_ai_tech_lift": _lift("('lang', 'bi', 'db', 'cloud')"),
    "f5_opportunity": _silver(f"""
, g AS (SELECT role, region, seniority, count(*) AS n,
        {_mean("pay")} / (SELECT {_mean("pay")} FROM silver WHERE seniority IS NOT NULL) AS i,
        CAST(count(*) FILTER (ai_use) AS DOUBLE) / NULLIF(count(ai_use), 0) AS r
   FROM silver WHERE seniority IS NOT NULL GROUP BY ALL)
SELECT role, region, seniority, n, round(i * 100, 4) AS pay_index, round(r, 4) AS ai_rate,
       round(i * (1 - r), 6) AS score,
       rank() OVER (ORDER BY round(i * (1 - r), 6) DESC NULLS LAST) AS place
FROM g""".lstrip()),
}
