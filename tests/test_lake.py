"""Files, layers, reprocessing and the catalog."""

import datetime
import os

import pytest
from pyspark.sql import functions as F, types as T

from surveylake.checks.survey import survey_batches, survey_silver
from surveylake.plans import jobs
from surveylake.plans.cells import FAMILIES, STORED, cells, from_cells
from surveylake.plans.cells import family as cells_of
from surveylake.plans.fronts import GOLD_TABLES
from surveylake.plans.jobs import main, refresh_silver, reprocess, run_bronze, run_gold, run_layer, run_silver
from surveylake.rules import RAW_COLUMNS, SILVER_SCHEMA
from surveylake.sources.catalog import analyse, dictionary, register, sql
from surveylake.sources.lake import (
    Lake, export_csv, paths, read_csv_export, read_table, snapshots, stage, tables, vacuum, write_batch, write_table,
)
from surveylake.sources.raw import CORRUPT, ORIGIN, land_bronze, read_raw, trace

HEADER = ",".join(RAW_COLUMNS)


def write(path, *lines, header=HEADER):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def line(key, role="Dev", pay="10,00", day="01/01/2000", langs="SQL;Python"):
    return f'{key},{role},Sul,PR,Pleno,"{pay}",Remoto,{day},Sim,{langs},,,'


def rows(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=str)


@pytest.fixture
def lake(tmp_path, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name)
    return Lake(str(tmp_path / "lake"), prefix=name[:40].lower())


def test_csv_edges(spark, tmp_path):
    path = str(tmp_path / "edge.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write('"(\'P1_a \', \'Idade\')",b,c\n"x, y","say ""hi""",ção\n"two\nlines","",\n')
    columns = ["('P1_a ', 'Idade')", "b", "c"]
    df = read_raw(spark, path, columns, multi_line=True)
    assert df.columns == [*columns, *ORIGIN]
    got = [tuple(r)[:3] for r in df.collect()]
    df = df.select(*[F.col(f"`{c}`") for c in columns])
    assert got[0] == ("x, y", 'say "hi"', "ção")
    assert got[1][0] == "two\nlines" and not got[1][1] and got[1][2] is None
    assert all(t == "string" for _, t in df.dtypes)


def test_other_header_is_refused(spark, tmp_path):
    path = write(str(tmp_path / "in" / "a.csv"), "1,2", header="a,zzz")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, path, ["a", "b"]).collect()


def test_unreadable_lines_stay_visible(spark, tmp_path):
    path = write(str(tmp_path / "in" / "a.csv"), "1,x", "2", "3,y,z", header="a,b")
    df = read_raw(spark, path, ["a", "b"], corrupt=CORRUPT).cache()
    assert rows(df, "a", "b", CORRUPT) == sorted([("1", "x", None), ("2", None, "2"), ("3", "y", "3,y,z")], key=str)


def test_landing_loses_nothing(spark, tmp_path, lake):
    one, two = str(tmp_path / "in1"), str(tmp_path / "in2")
    write(f"{one}/a.csv", "1,x", "2", "3,y,EXTRA", header="resp_id,role")
    write(f"{one}/b.csv", "4,z,new answer", header="resp_id,role,Another question?")
    write(f"{two}/c.csv", "5;ção", header="resp_id;state")
    run_bronze(spark, lake, one, 1)
    run_bronze(spark, lake, two, 2, sep=";")
    bronze = read_table(spark, lake, "bronze", "answers")
    assert {"resp_id", "role", "state", "Another question?", CORRUPT, "_row_id", "_batch_id", *ORIGIN} == set(bronze.columns)
    got = {r["resp_id"]: r for r in bronze.collect()}
    assert got["3"][CORRUPT] == "3,y,EXTRA" and got["2"][CORRUPT] == "2" and got["1"][CORRUPT] is None
    assert got["4"]["Another question?"] == "new answer" and got["5"]["state"] == "ção" and got["5"]["role"] is None
    assert len({(r["_batch_id"], r["_row_id"]) for r in got.values()}) == 5
    assert "Another question?" in spark.table(f"{lake.database('bronze')}.answers").columns


def test_trace_is_exact_for_repeats_in_a_batch(spark, tmp_path, lake):
    raw = str(tmp_path / "in")
    write(f"{raw}/a.csv", line(1), line(1, pay="20,00"))
    run_bronze(spark, lake, raw, 1)
    run_silver(spark, lake, csv=False)
    bronze, silver = read_table(spark, lake, "bronze", "answers"), read_table(spark, lake, "silver", "answers")
    traced = [(int(r["pay"]), r["raw_pay"]) for r in trace(silver, bronze).collect()]
    assert traced == [(20, "20,00")]


def test_landing_keeps_the_origin_and_replaces_one_batch(spark, tmp_path, lake):
    a = write(str(tmp_path / "in1" / "a.csv"), line(1), line(2))
    b = write(str(tmp_path / "in2" / "b.csv"), line(3))
    for batch, path in ((1, a), (2, b), (1, a)):
        land_bronze(read_raw(spark, path), lake, batch)
    bronze = read_table(spark, lake, "bronze", "answers")
    assert rows(bronze, "resp_id", "_batch_id") == [("1", 1), ("2", 1), ("3", 2)]
    files = {(r["resp_id"], os.path.basename(r["_source_file"])) for r in bronze.collect()}
    assert files == {("1", "a.csv"), ("2", "a.csv"), ("3", "b.csv")}
    assert bronze.filter(F.col("_source_time").isNull()).count() == 0
    # the pay column holds a comma inside quotes
    assert bronze.first()["pay"] == "10,00"


def test_a_batch_may_become_empty(spark, tmp_path, lake):
    path = write(str(tmp_path / "in" / "a.csv"), line(1))
    empty = write(str(tmp_path / "in0" / "a.csv"))
    land_bronze(read_raw(spark, path), lake, 1)
    land_bronze(read_raw(spark, path), lake, 2)
    land_bronze(read_raw(spark, empty), lake, 1)
    assert rows(read_table(spark, lake, "bronze", "answers"), "resp_id", "_batch_id") == [("1", 2)]


def test_layers_trace_and_reprocess(spark, tmp_path, lake):
    one = str(tmp_path / "in1")
    two = str(tmp_path / "in2")
    write(f"{one}/a.csv", line(1), line(2, pay="20,00"), line("", role="nobody"))
    write(f"{two}/b.csv", line(2, pay="30,00", day="01/01/2001"), line(3, day="99/99/2000", langs=""))
    run_layer(spark, lake, "bronze", raw=one, batch_id=1)
    run_bronze(spark, lake, two, 2)
    run_layer(spark, lake, "silver")
    run_gold(spark, lake, ["f2_pay_seniority", "f4_adoption", "f4_tech_pairs"])

    silver = read_table(spark, lake, "silver", "answers")
    assert rows(silver, "resp_id", F.col("pay").cast("int"), "edition", "_batch_id") == sorted(
        [(1, 10, 2000, 1), (2, 30, 2001, 2), (3, 10, None, 2)], key=str)
    assert read_table(spark, lake, "silver", "quarantine").count() == 1
    assert rows(read_table(spark, lake, "silver", "tech"), "resp_id", "technology") == [
        (1, "PYTHON"), (1, "SQL"), (2, "PYTHON"), (2, "SQL")]
    assert rows(read_table(spark, lake, "gold", "f4_adoption"), "technology", "n", "base") == [
        ("PYTHON", 2, 2), ("SQL", 2, 2)]
    assert rows(read_table(spark, lake, "gold", "f4_tech_pairs"), "a", "b", "n", "lift") == [
        ("lang:PYTHON", "lang:SQL", 2, 1.0)]

    bronze = read_table(spark, lake, "bronze", "answers")
    traced = trace(silver, bronze, keys=[2])
    assert [(r["resp_id"], r["raw_pay"], os.path.basename(r["_source_file"])) for r in traced.collect()] == [
        (2, "30,00", "b.csv")]
    keys = spark.createDataFrame([(1,), (1,), (3,)], "resp_id bigint")
    assert trace(silver, bronze, keys).count() == 2

    # the second delivery is corrected and loaded again
    before = rows(silver, "resp_id", "pay")
    write(f"{two}/b.csv", line(2, pay="40,00", day="01/01/2001"))
    for _ in range(2):
        reprocess(spark, lake, {2: two}, csv=False)
        silver = read_table(spark, lake, "silver", "answers")
        assert rows(silver, "resp_id", F.col("pay").cast("int")) == [(1, 10), (2, 40)]
    assert before != rows(silver, "resp_id", "pay")
    assert rows(read_table(spark, lake, "bronze", "answers"), "resp_id", "_batch_id") == sorted(
        [("1", 1), ("2", 1), (None, 1), ("2", 2)], key=str)


def test_silver_in_parquet_and_csv_hold_the_same(spark, small, lake):
    batches = survey_batches(spark, small)
    for batch in (1, 2):
        write_batch(batches.filter(F.col("_batch_id") == batch).drop("_batch_id"), lake, "answers", batch)
    run_silver(spark, lake)
    stored = read_table(spark, lake, "silver", "answers")
    schema = T.StructType([f for f in SILVER_SCHEMA])
    back = read_csv_export(spark, lake.path("silver", "answers_csv"), T.StructType(list(stored.schema)))
    names = [f.name for f in schema]
    # an empty list and a missing one are the same text
    def flat(df):
        return df.select(*names).withColumn(
            "issues", F.when(F.size("issues") > 0, F.array_remove("issues", "")))
    assert sorted(map(str, flat(stored).collect())) == sorted(map(str, flat(back).collect()))
    assert {f.name: f.dataType for f in stored.schema} == {f.name: f.dataType for f in schema}
    assert stored.count() == batches.filter("resp_id <> ''").select("resp_id").distinct().count()


def test_write_table_replaces_and_prunes_partitions(spark, lake):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("edition"))
    write_table(df, lake, "silver", "t", ["edition"])
    write_table(df.filter("id < 50"), lake, "silver", "t", ["edition"])
    back = read_table(spark, lake, "silver", "t")
    assert back.count() == 50
    plan = back.filter("edition = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(edition" in plan
    with pytest.raises(ValueError):
        lake.path("platinum", "t")


def test_small_gold_table_is_one_file(spark, lake):
    path = write_table(spark.range(1000).repartition(8).groupBy((F.col("id") % 7).alias("k")).count(), lake, "gold", "g")
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1


def test_csv_export_escapes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', ["x", "y"], datetime.date(2000, 1, 2)), (2, None, None, None)],
                               "id int, t string, l array<string>, d date")
    path = export_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, read_csv_export(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_catalog(spark, lake):
    df = spark.range(10).select(F.col("id").alias("resp_id"), (F.col("id") % 2).cast("int").alias("edition"))
    write_table(df, lake, "silver", "answers", ["edition"])
    for _ in range(2):
        name = register(spark, lake, "silver", "answers", "it's the answers")
        assert spark.table(name).count() == 10
    write_table(df.filter("edition = 1"), lake, "silver", "answers", ["edition"])
    register(spark, lake, "silver", "answers")
    assert sql(spark, f"SELECT count(*) AS n FROM {name}").first()["n"] == 5
    analyse(spark, lake, "silver", "answers")
    described = {r["column"]: r for r in dictionary(spark, lake, "silver").collect()}
    assert described["resp_id"]["comment"] == "key of the answer"
    assert described["edition"]["partition"] and described["resp_id"]["type"] == "bigint"
    assert dictionary(spark, lake, "gold").count() == 0

    write_table(df.withColumn("more", F.lit(1)), lake, "silver", "answers", ["edition"])
    register(spark, lake, "silver", "answers", replace=True)
    assert "more" in spark.table(name).columns


def test_command_line(spark, tmp_path, lake):
    raw = str(tmp_path / "in")
    write(f"{raw}/a.csv", line(1))
    with pytest.raises(SystemExit):
        main(["bronze", "--lake", lake.root])
    with pytest.raises(ValueError):
        run_layer(spark, lake, "platinum")
    assert set(GOLD_TABLES) >= {"f1_profile", "f5_opportunity"}


# --- snapshots and incremental runs --------------------------------------------


def files(lake, layer, spark):
    """Every file that the newest snapshot of a layer names, by table and partition."""
    return {(t.name, f): sorted(x for x in os.listdir(path) if x.endswith(".parquet")) and path
            for t in tables(spark, lake, layer).values() for f, path in paths(lake, layer, t).items()}


def contents(lake, layer, spark):
    return {name: (sorted(df.dtypes), rows(df, *sorted(df.columns))) for name in tables(spark, lake, layer)
            for df in [read_table(spark, lake, layer, name)]}


def test_a_job_that_dies_leaves_the_old_table(spark, lake):
    df = spark.range(100, numPartitions=4).select("id", (F.col("id") % 3).cast("int").alias("edition"))
    write_table(df, lake, "silver", "t", ["edition"])
    before = files(lake, "silver", spark)
    dies = df.withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("died half-way")).cast("bigint")).otherwise(F.col("id")))
    for _ in range(2):
        with pytest.raises(Exception, match="died half-way"):
            write_table(dies, lake, "silver", "t", ["edition"])
        assert files(lake, "silver", spark) == before and read_table(spark, lake, "silver", "t").count() == 100
    write_table(df.filter("id < 10"), lake, "silver", "t", ["edition"])
    assert read_table(spark, lake, "silver", "t").count() == 10
    assert read_table(spark, lake, "silver", "t", snapshot=1).count() == 100


def test_silver_tables_change_together(spark, tmp_path, lake, monkeypatch):
    raw = str(tmp_path / "in")
    write(f"{raw}/a.csv", line(1), line(2))
    run_bronze(spark, lake, raw, 1)
    run_silver(spark, lake, csv=False)
    before = contents(lake, "silver", spark)
    write(f"{raw}/a.csv", line(1, pay="77,00"), line(3))
    run_bronze(spark, lake, raw, 1)
    whole = jobs.explode_tech
    monkeypatch.setattr(jobs, "explode_tech", lambda *a, **k: whole(*a, **k).withColumn("technology", F.raise_error(F.lit("died"))))
    with pytest.raises(Exception, match="died"):
        refresh_silver(spark, lake, csv=False)
    assert contents(lake, "silver", spark) == before
    monkeypatch.undo()
    # the keys of the batch's old files are not forgotten: answer 2 goes
    refresh_silver(spark, lake, csv=False)
    assert rows(read_table(spark, lake, "silver", "answers"), "resp_id", F.col("pay").cast("int")) == [(1, 77), (3, 10)]


def test_an_unfinished_snapshot_does_not_count(spark, lake):
    write_table(spark.range(3), lake, "gold", "t")
    os.makedirs(f"{lake.path('gold', '_snapshots')}/0000000002")
    assert snapshots(spark, lake, "gold") == [1] and read_table(spark, lake, "gold", "t").count() == 3
    write_table(spark.range(4), lake, "gold", "t")
    assert snapshots(spark, lake, "gold") == [1, 3] and read_table(spark, lake, "gold", "t").count() == 4


def test_empty_tables_and_missing_ones(spark, lake):
    df = spark.createDataFrame([], "id bigint, edition int")
    write_table(df, lake, "silver", "t", ["edition"])
    assert read_table(spark, lake, "silver", "t").columns == ["id", "edition"] and read_table(spark, lake, "silver", "t").count() == 0
    with pytest.raises(ValueError, match="no table"):
        read_table(spark, lake, "silver", "other")
    with pytest.raises(ValueError, match="no snapshot"):
        read_table(spark, lake, "silver", "t", snapshot=9)


def test_vacuum_keeps_what_is_in_use(spark, lake):
    for n in (1, 2, 3):
        write_table(spark.range(n), lake, "gold", "t")
    stage(spark.range(9), lake, "gold", "t")
    assert vacuum(spark, lake, "gold") == 1  # files are young, the first snapshot goes
    assert vacuum(spark, lake, "gold", keep=1, older_than=-60) == 4
    assert snapshots(spark, lake, "gold") == [3] and read_table(spark, lake, "gold", "t").count() == 3
    with pytest.raises(ValueError):
        vacuum(spark, lake, "gold", keep=0)


SOME_OF_EACH_FAMILY = ["f1_edition_change", "f2_pay_role_seniority", "f3_pay_state", "f4_adoption", "f4_pay_tech"]


def test_only_touched_editions_get_new_files(spark, tmp_path, lake):
    """A batch is corrected: other editions keep their files, and all tables equal a full rebuild."""
    one, two, three = (str(tmp_path / f"in{i}") for i in (1, 2, 3))
    write(f"{one}/a.csv", *[line(k, day=f"01/01/{2000 + k % 5}", pay=f"{k},50", langs="SQL;R" if k % 2 else "SQL") for k in range(1, 41)], line("", role="x"))
    write(f"{two}/b.csv", line(7, day="01/01/2002", pay="99,00"), line(8, day="01/01/2003"), line(50, day="31/31/2000"), line("x"))
    write(f"{three}/c.csv", line(60, day="01/01/2004"))
    for batch, raw in ((1, one), (2, two), (3, three)):
        run_bronze(spark, lake, raw, batch)
    run_silver(spark, lake, csv=False)
    run_gold(spark, lake, SOME_OF_EACH_FAMILY)
    old_silver, old_gold = files(lake, "silver", spark), files(lake, "gold", spark)

    # 7 moves from 2002 back to its first answer (2002), 8 from 2003 to 2001, 50 gets a day, 51 is new in 2003
    write(f"{two}/b.csv", line(8, day="01/01/2001"), line(50, day="01/01/2001"), line(" 51 ", day="01/01/2003", pay="1,00"))
    editions = reprocess(spark, lake, {2: two}, csv=False)
    none = "edition=__HIVE_DEFAULT_PARTITION__"
    assert editions == sorted(["edition=2001", "edition=2002", "edition=2003", none])
    new_silver, new_gold = files(lake, "silver", spark), files(lake, "gold", spark)
    assert {cells_of(n) for n in SOME_OF_EACH_FAMILY} == set(FAMILIES)
    for before, after, names in ((old_silver, new_silver, ("answers", "tech")), (old_gold, new_gold, STORED)):
        for name in names:
            for edition in ("edition=2000", "edition=2004"):
                assert after[name, edition] == before[name, edition]
            for edition in ("edition=2001", "edition=2003"):
                assert after[name, edition] != before[name, edition]
            assert (name, none) in before and (name, none) not in after
    assert new_silver["quarantine", "_batch_id=1"] == old_silver["quarantine", "_batch_id=1"] and ("quarantine", "_batch_id=2") not in new_silver

    assert reprocess(spark, lake, {}, csv=False) == [] and files(lake, "gold", spark) == new_gold
    kept = contents(lake, "silver", spark), contents(lake, "gold", spark)
    run_silver(spark, lake, csv=False)
    run_gold(spark, lake, SOME_OF_EACH_FAMILY)
    assert kept == (contents(lake, "silver", spark), contents(lake, "gold", spark))
    # the catalog has followed
    assert spark.table(f"{lake.database('silver')}.answers").count() == read_table(spark, lake, "silver", "answers").count() == 43


def test_gold_from_counts_equals_gold_from_answers(spark, small):
    """Every gold table, from the stored families of counts and straight from the answers."""
    answers = survey_silver(spark, small).persist()
    stored = {name: cells(answers, name).persist() for name in FAMILIES}
    for name, build in GOLD_TABLES.items():
        counted, direct = from_cells(name, stored.__getitem__), build(answers)
        assert counted.dtypes == direct.dtypes, name
        assert rows(counted, *counted.columns) == rows(direct, *direct.columns), name
    assert stored["cells_people"].agg(F.sum("_weight")).first()[0] == answers.count()
