"""The silver layer as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from surveylake.functions import list_size, split_list, standard
from surveylake.operators.category import map_category
from surveylake.operators.dedupe import dedupe
from surveylake.operators.derive import add_aux, add_band
from surveylake.operators.invalid import check_range, split_quarantine
from surveylake.operators.issues import no_issues
from surveylake.operators.missing import null_sentinels
from surveylake.operators.technology import explode_tech
from surveylake.operators.typed import enforce_schema, to_date_fmt, to_decimal_br
from surveylake.rules import MISSING_WORDS, RAW_COLUMNS, SILVER_SCHEMA, TECH_CATEGORIES, SilverRules

_NAMES = ("role", "region", "state")


def build_silver(raw: DataFrame, rules: SilverRules = SilverRules()) -> DataFrame:
    """Typed, standard answers; one row out for every row in, and no shuffle.

    Only the columns present in ``raw`` are treated, so a job that needs two
    questions reads two. A column derived from several questions (``n_tools``)
    appears when all of them are there.
    """
    here = set(raw.columns)
    df = no_issues(raw)

    # "no answer" to NULL: before types, so that a missing value is
    # not reported as an unreadable one; lists drop the usual words by themselves
    lists = [c for c in TECH_CATEGORIES if c in here]
    dropped = all(w in MISSING_WORDS and rules.multi_sep not in w for w in rules.missing_words)
    texts = [c for c in RAW_COLUMNS[1:] if c in here and not (dropped and c in lists)]
    df = null_sentinels(df, texts, rules.missing_words)

    for c in _NAMES:
        if c in here and c in rules.names:
            df = map_category(df, c, rules.names[c])
        elif c in here:
            df = df.withColumn(c, standard(c))
    if "resp_id" in here:
        df = df.withColumn("resp_id", F.trim(F.col("resp_id").cast("string")).try_cast("bigint"))
    if "pay" in here:
        df = to_decimal_br(df, "pay")
        df = check_range(df, "pay", lo=0, lo_open=True)
        df = add_band(df, "pay", rules.pay_edges, rules.pay_labels, "pay_band", rules.no_pay)
    if "answered_at" in here:
        df = to_date_fmt(df, "answered_at", rules.date_format)
        df = add_aux(df, {"edition": F.year("answered_at")})
    if "seniority" in here:
        df = map_category(df, "seniority", rules.seniority, rank_col="seniority_rank")
    if "work_model" in here:
        df = map_category(df, "work_model", rules.work_model)
    if "ai_use" in here:
        df = map_category(df, "ai_use", rules.yes_no)
    df = df.withColumns({c: split_list(c, rules.multi_sep) for c in lists})
    if len(lists) == len(TECH_CATEGORIES):
        sizes = [list_size(c) for c in lists]
        df = add_aux(df, {"n_tools": sum(sizes[1:], sizes[0])})

    contract = [f for f in SILVER_SCHEMA if f.name in df.columns]
    return enforce_schema(df, type(SILVER_SCHEMA)(contract))


def latest_answers(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One raw answer per key, the last landed of the latest batch; and the rows without a key."""
    keyed, rejected = split_quarantine(bronze, ["resp_id"])
    order = [c for c in ("_batch_id", "_row_id") if c in bronze.columns]
    return dedupe(keyed, ["resp_id"], order), rejected


def build_tech(silver: DataFrame) -> DataFrame:
    """One row per (answer, category, technology), distinct as it stands."""
    return explode_tech(silver)
