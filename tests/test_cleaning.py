"""Cleaning operators on small hand-written rows."""

import datetime
import re
from decimal import Decimal

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F, types as T

from surveylake.functions import split_list, text_key, to_date, to_flag, to_int, to_money
from surveylake.functions.text import is_missing_word, tidy
from surveylake.operators.category import map_category, mapping_from_rows, unmapped
from surveylake.operators.dedupe import dedupe
from surveylake.operators.derive import add_band, add_quantile_band, organise
from surveylake.operators.invalid import check_domain, check_range, quarantine_report, split_quarantine
from surveylake.operators.issues import issue_report
from surveylake.operators.lookups import join_group_values
from surveylake.operators.missing import drop_missing, fill_missing, impute, missing_report, null_sentinels
from surveylake.operators.technology import explode_tech
from surveylake.operators.typed import enforce_schema, to_decimal_br, to_type
from surveylake.plans.silver import build_silver, latest_answers
from surveylake.rules import MISSING_WORDS, SilverRules


def one(spark, column, value, type_="string"):
    return spark.createDataFrame([(value,)], f"c {type_}").select(column.alias("c")).first()["c"]


def rows(df, *cols):
    return sorted([tuple(r) for r in (df.select(*cols) if cols else df).collect()], key=str)


@pytest.mark.parametrize("text, value", [
    ("1.234,56", "1234.56"), ("R$ 10,5", "10.50"), (" R$7 ", "7.00"), ("-1,00", "-1.00"),
    ("abc", None), ("", None), (None, None), ("99999999999999", None),
])
def test_money(spark, text, value):
    assert one(spark, to_money("c"), text) == (Decimal(value) if value else None)


@pytest.mark.parametrize("text, value", [
    ("12", 12), (" 12 ", 12), ("12.7", None), ("x", None), ("", None), (None, None),
])
def test_int(spark, text, value):
    assert one(spark, to_int("c"), text) == value


@pytest.mark.parametrize("text, value", [
    ("Sim", True), (" s ", True), ("NÃO", False), ("nao", False), ("talvez", None), (None, None),
])
def test_flag(spark, text, value):
    assert one(spark, to_flag("c"), text) is value


@pytest.mark.parametrize("text, value", [
    ("29/02/2000", datetime.date(2000, 2, 29)), ("31/02/2000", None), ("2000-01-01", None), (None, None),
])
def test_date(spark, text, value):
    assert one(spark, to_date("c"), text) == value


@pytest.mark.parametrize("text, key", [
    ("  SÊNIOR ", "senior"), ("Júnior", "junior"), ("a \t  b", "a b"), ("", ""), (None, None),
])
def test_text_key(spark, text, key):
    assert one(spark, text_key("c"), text) == key
    if key is not None:
        assert one(spark, text_key("c"), key) == key


@pytest.mark.parametrize("text, items", [
    ("b; a;b", ["A", "B"]), (";;", None), ("", None), (" x ", ["X"]), (None, None), ("a ;b", ["A", "B"]),
])
def test_split(spark, text, items):
    assert one(spark, split_list("c"), text) == items


def test_other_separators_are_taken_literally(spark):
    assert one(spark, split_list("c", "|"), "b | a|") == ["A", "B"]


def test_sentinels_and_report(spark):
    df = spark.createDataFrame([("N/A", 1), ("  ", 2), ("Não Informado", None), ("x", 4)], "a string, b int")
    clean = null_sentinels(df, ["a"])
    assert [r["a"] for r in clean.orderBy("b").collect()] == [None, None, None, "x"]
    assert rows(missing_report(clean)) == [("a", 4, 3, 0.75), ("b", 4, 1, 0.25)]


def test_report_of_no_rows(spark):
    assert rows(missing_report(spark.createDataFrame([], "a string"))) == [("a", 0, 0, None)]


def test_fill_and_drop(spark):
    df = spark.createDataFrame([(None, 1), ("x", None), (None, None)], "a string, b int")
    assert rows(fill_missing(df, {"a": "?", "b": 0})) == [("?", 0), ("?", 1), ("x", 0)]
    assert drop_missing(df, ["a", "b"], "any").count() == 0
    assert drop_missing(df, ["a", "b"], "all").count() == 2


def test_group_values_join(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "g string, v int")
    values = df.groupBy("g").agg(F.max("v").alias("m"))
    joined = join_group_values(df, values, ["g"])
    assert rows(joined) == sorted([("a", 1, 1), (None, 2, 2), ("b", 3, 3)], key=str)
    assert "strategy=broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("size", [3, 5_000])
def test_map_means_the_same_as_dict_and_as_table(spark, size):
    named = [(f"Função  {i}", f"L{i % 7}", i) for i in range(size)]
    df = spark.createDataFrame([("FUNCAO 1",), ("função\u00a02",), ("outra",), (None,)], "s string")
    as_dict = map_category(df, "s", mapping_from_rows(named), "rank")
    as_table = map_category(df, "s", spark.createDataFrame(named, "key string, label string, rank int"), "rank")
    want = sorted([("L1", 1, []), ("L2", 2, []), (None, None, ["s"]), (None, None, [])], key=str)
    assert rows(as_dict, "s", "rank", "issues") == rows(as_table, "s", "rank", "issues") == want


def test_keys_that_become_one_are_refused(spark):
    df = spark.createDataFrame([("x",)], "s string")
    with pytest.raises(ValueError, match="given twice"):
        map_category(df, "s", {"Júnior": "a", "junior ": "b"})


@pytest.mark.parametrize("text, value", [
    ("1234.56", None), ("1.2.3", None), ("1,239", None), ("R$\u00a010", Decimal("10.00")), ("r$ 1.234,5", Decimal("1234.50")),
    ("-1,00", Decimal("-1.00")), ("12.345.678,90", Decimal("12345678.90")), ("", None), (None, None),
])
def test_money_is_read_or_refused(spark, text, value):
    assert one(spark, to_money("c"), text) == value


def test_money_with_a_dot(spark):
    assert one(spark, to_money("c", point="."), "1,234.56") == Decimal("1234.56")


def test_missing_words_and_blanks_inside_lists(spark):
    assert one(spark, split_list("c"), "Power  BI; power bi;não  informado") == ["POWER BI"]


def test_impute(spark):
    data = [("a", Decimal(1), "x"), ("a", Decimal(3), "y"), ("a", None, None), (None, Decimal(5), "z"),
            (None, None, None), ("c", None, None)]
    df = spark.createDataFrame(data, "g string, v decimal(12,2), m string")
    filled = impute(df, "v", ["g"], "median")
    assert rows(filled.filter("v IS NULL"), "g", "v_filled") == [("a", 2.0), ("c", None), (None, 5.0)]
    # x and y are equally frequent: the smaller name wins
    filled = impute(df, "m", ["g"], "mode")
    assert rows(filled.filter("m IS NULL"), "g", "m_filled") == [("a", "x"), ("c", None), (None, "z")]
    with pytest.raises(ValueError):
        impute(df, "v", ["g"], "mean")


def test_range_actions(spark):
    df = spark.createDataFrame([(-1,), (0,), (5,), (11,), (None,)], "v int")
    assert rows(check_range(df, "v", 0, 10), "v", "issues") == sorted(
        [(None, ["v"]), (0, []), (5, []), (None, ["v"]), (None, [])], key=str)
    clamped = check_range(df, "v", 0, 10, "clamp")
    assert sorted(r["v"] for r in clamped.filter("v IS NOT NULL").collect()) == [0, 0, 5, 10]
    assert clamped.filter("v IS NULL").count() == 1
    assert clamped.schema["v"].dataType == T.IntegerType()
    assert check_range(df, "v", 0, 10, "flag").filter("size(issues) = 1").count() == 2
    assert check_range(df, "v", 0, lo_open=True).filter("size(issues) = 1").count() == 2
    with pytest.raises(ValueError):
        check_range(df, "v", 0, action="drop")


def test_domain_by_list_pattern_and_table(spark):
    df = spark.createDataFrame([("a1",), ("b2",), ("zz",), (None,)], "v string")
    want = sorted([("a1", []), ("b2", []), (None, ["v"]), (None, [])], key=str)
    allowed = spark.createDataFrame([("a1",), ("b2",), ("b2",), (None,)], "v string")
    assert rows(check_domain(df, "v", ["a1", "b2"]), "v", "issues") == want
    assert rows(check_domain(df, "v", regex="^[ab][0-9]$"), "v", "issues") == want
    assert rows(check_domain(df, "v", allowed), "v", "issues") == want


def test_issues_are_added_up(spark):
    df = spark.createDataFrame([("x", "y"), ("1", "2")], "a string, b string")
    df = to_type(to_type(df, "a", "int"), "b", "int")
    assert rows(issue_report(df)) == [("a", 1), ("b", 1)]


def test_quarantine(spark):
    data = [("1", "x", 1), (" 1 ", "y", 2), ("2", "x", 1), ("2", "x", 2), ("", "x", 1), (None, "x", 1), ("k", "x", 1)]
    df = spark.createDataFrame(data, "id string, v string, _batch_id int")
    keyed, rejected = split_quarantine(df, ["id"])
    assert (keyed.count(), rejected.count()) == (4, 3)
    assert keyed.schema["id"].dataType == T.LongType()
    assert rows(quarantine_report(df, ["id"], ["v"])) == [(7, 3, 2, 2, 1)]
    assert rows(quarantine_report(df.limit(0), ["id"], ["v"])) == [(0, 0, 0, 0, 0)]


MAP_ROWS = [("junior", "Júnior", 1), ("jr", "Júnior", 1), ("senior", "Sênior", 3)]


def test_category_map_two_spellings_to_one_label(spark):
    df = spark.createDataFrame([("JR",), ("júnior",), ("Sênior",), ("chefe",), (None,)], "s string")
    want = sorted([("Júnior", 1, []), ("Júnior", 1, []), ("Sênior", 3, []), (None, None, ["s"]), (None, None, [])], key=str)
    inline = map_category(df, "s", mapping_from_rows(MAP_ROWS), "rank")
    table = spark.createDataFrame(MAP_ROWS, "key string, label string, rank int")
    assert rows(inline, "s", "rank", "issues") == want
    assert rows(map_category(df, "s", table, "rank"), "s", "rank", "issues") == want
    for mapping in (mapping_from_rows(MAP_ROWS), table):
        assert rows(unmapped(df, "s", mapping)) == [("chefe", 1)]


def test_duplicate_key_is_refused(spark):
    twice = [*MAP_ROWS, ("jr", "Pleno", 2)]
    with pytest.raises(ValueError, match="given twice"):
        mapping_from_rows(twice)
    table = spark.createDataFrame(twice, "key string, label string, rank int")
    df = spark.createDataFrame([("jr",)], "s string")
    with pytest.raises(SparkRuntimeException, match="given twice"):
        map_category(df, "s", table).collect()


def test_map_table_is_broadcast_when_small(spark, tmp_path):
    path = str(tmp_path / "map")
    spark.createDataFrame(MAP_ROWS, "key string, label string, rank int").write.parquet(path)
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("s"))
    joined = map_category(df, "s", spark.read.parquet(path))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_bands(spark):
    df = spark.createDataFrame([(None,), (9.0,), (10.0,), (20.0,)], "v double")
    banded = add_band(df, "v", [10, 20], ["A", "B", "C"], missing="none")
    assert [r["v_band"] for r in banded.orderBy("v").collect()] == ["none", "A", "B", "C"]
    with pytest.raises(ValueError):
        add_band(df, "v", [10], ["A"])
    with pytest.raises(ValueError):
        add_band(df, "v", [20, 10], ["A", "B", "C"])


def test_quantile_band(spark):
    df = spark.range(1, 101).select(F.lit("g").alias("g"), F.col("id").cast("int").alias("v"))
    sizes = add_quantile_band(df, "v", ["g"], 4).groupBy("v_group").count()
    assert rows(sizes) == [(1, 25), (2, 25), (3, 25), (4, 25)]


def test_organise_takes_odd_headers(spark):
    df = spark.createDataFrame([(1, 2)], ["('P1_a ', 'Idade')", "x.y"])
    assert organise(df, {"idade": "('P1_a ', 'Idade')", "z": "x.y"}).first().asDict() == {"idade": 1, "z": 2}


def test_dedupe_latest_wins_and_is_repeatable(spark):
    data = [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, None), (3, 1, "x"), (3, 1, "x")]
    df = spark.createDataFrame(data, "k int, b int, v string")
    want = [(1, 2, "c"), (2, 1, None), (3, 1, "x")]
    for parts in (1, 8):
        kept = dedupe(df.repartition(parts), ["k"], ["b"])
        assert rows(kept) == want and kept.columns == df.columns
    assert rows(dedupe(kept, ["k"], ["b"])) == want


def test_one_key_with_most_rows_sends_one_row_per_task(spark):
    df = spark.range(0, 20_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("b")
    )
    kept = dedupe(df, ["k"], ["b"])
    assert kept.count() == 20_000 // 3 + 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_schema_contract(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("x", "7", 1), ("y", "?", 2)], "b string, a string, extra int")
    out = enforce_schema(df, schema)
    assert out.schema == schema and rows(out) == sorted([(7, "x"), (None, "y")], key=str)
    with pytest.raises(ValueError, match="missing"):
        enforce_schema(df.drop("a"), schema)


def test_tech_long_with_base(spark):
    df = spark.createDataFrame([(1, ["A", "B"], None), (2, None, ["C"]), (3, None, None)],
                               "resp_id int, langs array<string>, clouds array<string>")
    cols = {"langs": "lang", "clouds": "cloud"}
    assert rows(explode_tech(df, cols)) == [(1, "lang", "A"), (1, "lang", "B"), (2, "cloud", "C")]
    based = explode_tech(df, cols, with_base=True).filter("technology IS NULL")
    assert rows(based, "resp_id", "category") == [(1, "lang"), (2, "cloud")]


def test_silver_keeps_rows_and_takes_some_columns(spark, small):
    from surveylake.checks.survey import survey_raw

    raw = survey_raw(spark, small)
    silver = build_silver(raw)
    assert silver.count() == raw.count() == silver.select("resp_id").distinct().count()
    part = build_silver(raw.select("resp_id", "seniority"))
    assert part.columns == ["resp_id", "seniority", "seniority_rank", "issues"]


def test_missing_word_is_not_an_issue(spark):
    raw = spark.createDataFrame([("1", "não informado"), ("2", "abc"), ("3", "-5,00")], "resp_id string, pay string")
    silver = build_silver(raw)
    assert rows(silver, "resp_id", "pay", "issues") == [(1, None, []), (2, None, ["pay"]), (3, None, ["pay"])]


def test_latest_answers_sees_the_same_key_in_two_spellings(spark):
    data = [("7", 1, "a"), (" 7 ", 2, "b"), ("", 2, "c")]
    kept, rejected = latest_answers(spark.createDataFrame(data, "resp_id string, _batch_id int, role string"))
    assert rows(kept) == [(7, 2, "b")] and rejected.count() == 1


def test_decimal_contract(spark):
    df = to_decimal_br(spark.createDataFrame([("1,005",)], "v string"), "v")
    assert df.schema["v"].dataType == T.DecimalType(12, 2)


def test_lists_are_split_as_by_the_pattern(spark):
    """A one-character separator, found without a pattern, gives the parts the pattern gives; longer ones still do."""
    texts = ["b; a;b", " ; ", ";;", "a ; ; b", "a ;; b", "x;  y\t;\nz ", "a;null;N/A ;b", "não  informado", "", None, "a b;a  b", "a|b | c", "a/ b /n/a", "a, b ,c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for sep in (";", "|", "/", ", ", " ", ";;"):
        nothing = ["", *[w.upper() for w in MISSING_WORDS if w]]
        parts = F.split(F.upper(tidy("t")), f" *{re.escape(sep)} *")
        wanted = F.sort_array(F.array_except(parts, F.array(*[F.lit(w) for w in nothing])))
        rows = df.select(split_list("t", sep).alias("got"), wanted.alias("wanted")).collect()
        assert [r["got"] for r in rows] == [r["wanted"] or None for r in rows]


def analyzed(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_blanks_are_reduced_once_per_text(spark):
    df = spark.createDataFrame([(" Sao   PAULO", "a")], "t string, u string")
    key = df.select(text_key("t").alias("k"))
    assert analyzed(key).count("regexp_replace") == 1
    assert key.first()["k"] == "sao paulo"


def test_lists_of_answers_are_tidied_once(spark):
    """Lists drop missing words by themselves; other words of the rules still count."""
    raw = spark.createDataFrame([("1", "sql; N/A", " n/a", "-", None)], "resp_id string, langs string, bi_tools string, databases string, clouds string")
    silver = build_silver(raw)
    assert silver.first().asDict() | {"issues": 0} == {"resp_id": 1, "langs": ["SQL"], "bi_tools": None, "databases": ["-"], "clouds": None, "n_tools": 2, "issues": 0}
    assert analyzed(silver).count("regexp_replace") == 4
    for rules in (SilverRules(missing_words=(*MISSING_WORDS, "-")), SilverRules(missing_words=("-",))):
        assert build_silver(raw, rules).first()["databases"] is None
    slash = spark.createDataFrame([("1", "n/a", "a/b", "c", "d")], raw.schema)
    assert build_silver(slash, SilverRules(multi_sep="/")).first()["langs"] is None


def test_missing_words_are_told_by_one_pattern(spark):
    """The same texts as by tidying, lowering and comparing: other letters with these lower cases, blanks of all kinds, odd words."""
    words = (*MISSING_WORDS, "kaß å.ÿ+", "Upper", " edge", "two  blanks", "[x]")
    odd = ["", " ", "k", "K", "\u212a", "i", "I", "\u0130", "\u0131", "s", "S", "\u017f", "ß", "\u1e9e", "SS", "\u212b", "Å", "\u0178", "\u00a0", "\u2003",
           "\u0085", "\u200b", "\t", "\r\n", "\n", "\x1c", "\U00010400", "e\u0301"]
    texts = [None, *odd]
    for w in words:
        for i in range(len(w) + 1):
            texts += [f(w[:i] + x + w[i:]) for x in odd for f in (str, str.upper)] + [f(w[:i] + x + w[i + 1:]) for x in odd for f in (str, str.title)]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    for given in (words, ("\u03c9",), ("Upper",), ()):
        found = is_missing_word("c", given)
        want = F.coalesce(F.lower(tidy("c")).isin(*given), F.lit(False))
        assert df.where(found.isNull() | (found != want)).collect() == []
    assert df.where(is_missing_word("c", words)).count() > 400
    plan = df.select(is_missing_word("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and "regexp_replace" not in plan
