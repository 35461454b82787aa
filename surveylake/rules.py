"""Fixed values of the survey: missing words, accents, categories, bands, schemas.

Nothing here is computed from data. Rules that grow with the data (long lists,
large category maps) are passed to the operators as DataFrames instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

# Answers that mean "no answer", compared after trimming and lower-casing.
MISSING_WORDS = ("", "n/a", "null", "não informado", "nao informado", "sem resposta")

# Accented letters of Portuguese and neighbours, and what replaces each of them.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"

# Text key -> (label, rank).
SENIORITY = {
    "junior": ("Júnior", 1),
    "pleno": ("Pleno", 2),
    "senior": ("Sênior", 3),
    "gestor": ("Gestor", 4),
}

# Text key -> label.
WORK_MODEL = {
    "presencial": "Presencial",
    "hibrido": "Híbrido",
    "remoto": "Remoto",
}

# Text key -> truth value.
YES_NO = {"sim": True, "s": True, "nao": False, "n": False}

# Pay bands: below the first edge, between the edges, from the last edge on.
PAY_EDGES = (100_000, 300_000)
PAY_LABELS = ("A", "B", "C")
NO_PAY = "sem dado"

DATE_FORMAT = "dd/MM/yyyy"
MULTI_SEP = ";"

# Many-choice column -> category name in the long technology table.
TECH_CATEGORIES = {"langs": "lang", "bi_tools": "bi", "databases": "db", "clouds": "cloud"}

RAW_COLUMNS = (
    "resp_id", "role", "region", "state", "seniority", "pay", "work_model",
    "answered_at", "ai_use", "langs", "bi_tools", "databases", "clouds",
)

# --- end of fixed values ----------------------------------------------------

_text_list = T.ArrayType(T.StringType())

SILVER_SCHEMA = T.StructType([
    T.StructField("resp_id", T.LongType()),
    T.StructField("edition", T.IntegerType()),
    T.StructField("answered_at", T.DateType()),
    T.StructField("role", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("seniority", T.StringType()),
    T.StructField("seniority_rank", T.IntegerType()),
    T.StructField("pay", T.DecimalType(12, 2)),
    T.StructField("pay_band", T.StringType()),
    T.StructField("work_model", T.StringType()),
    T.StructField("ai_use", T.BooleanType()),
    T.StructField("langs", _text_list),
    T.StructField("bi_tools", _text_list),
    T.StructField("databases", _text_list),
    T.StructField("clouds", _text_list),
    T.StructField("n_tools", T.IntegerType()),
    T.StructField("issues", _text_list),
    T.StructField("_batch_id", T.IntegerType()),
    T.StructField("_row_id", T.LongType()),
])

# Column comments of the data dictionary.
COMMENTS = {
    "resp_id": "key of the answer",
    "edition": "year the answer was given",
    "answered_at": "day the answer was given",
    "role": "professional profile",
    "region": "region of the country",
    "state": "state of the region",
    "seniority": "seniority label",
    "seniority_rank": "order of the seniority label, 1 is the lowest",
    "pay": "pay, NULL when missing or invalid",
    "pay_band": "pay band",
    "work_model": "on site, hybrid or remote",
    "ai_use": "uses AI at work",
    "langs": "programming languages",
    "bi_tools": "BI tools",
    "databases": "databases",
    "clouds": "cloud technologies",
    "n_tools": "number of technologies over the four lists",
    "issues": "columns whose answer was present but rejected",
    "_batch_id": "raw batch the row comes from",
    "_row_id": "raw row in that batch",
    "category": "kind of technology",
    "technology": "technology name",
}


@dataclass(frozen=True)
class SilverRules:
    """What ``build_silver`` applies; replace fields for another questionnaire."""

    missing_words: tuple = MISSING_WORDS
    # column -> {key: label} or a DataFrame key, label; a column without a map gets
    # one spelling per text key
    names: dict = field(default_factory=dict)
    seniority: dict = field(default_factory=lambda: dict(SENIORITY))
    work_model: dict = field(default_factory=lambda: dict(WORK_MODEL))
    yes_no: dict = field(default_factory=lambda: dict(YES_NO))
    pay_edges: tuple = PAY_EDGES
    pay_labels: tuple = PAY_LABELS
    no_pay: str = NO_PAY
    date_format: str = DATE_FORMAT
    multi_sep: str = MULTI_SEP
