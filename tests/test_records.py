"""Records with line breaks inside quotes, over the borders of splits; headers of many files."""

import random

import pytest
from pyspark.sql import functions as F

from surveylake.plans.jobs import run_bronze
from surveylake.sources.lake import Lake, read_table
from surveylake.sources.raw import CORRUPT, ORIGIN, ROW_ID, files_by_header, read_raw
from surveylake.sources.records import header_names, raw_lines, split_records


@pytest.fixture
def small_splits(spark):
    """Splits of 64 bytes, as a large file has splits of 128 MB."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, ("64", "1", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def field(rng):
    kind = rng.randrange(8)
    plain = "".join(rng.choice("abcé 5") for _ in range(rng.randrange(12)))
    if kind < 3:
        return plain
    if kind == 3:
        return plain + '"' + plain if plain and not plain.startswith('"') else plain  # a quote inside an unquoted field is text
    inside = "".join(rng.choice(["a", "b,", "\n", '""', "\n\n", "long " * 9, "é"]) for _ in range(rng.randrange(14)))
    return f'"{inside}"'


def csv_text(seed, rows=120, width=3):
    rng = random.Random(seed)
    lines = [",".join(["a", "b", "c"][:width])]
    lines += [",".join(field(rng) for _ in range(width)) for _ in range(rows)]
    return "\n".join(lines) + "\n"


def by_spark(spark, path, corrupt=False):
    """Spark's own reader: one task per file."""
    schema = "a string, b string, c string" + (f", {CORRUPT} string" if corrupt else "")
    read = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')
    return [tuple(r) for r in read.option("columnNameOfCorruptRecord", CORRUPT).csv(path).collect()]


@pytest.mark.parametrize("seed", range(6))
def test_same_as_the_reader_of_whole_files(spark, tmp_path, small_splits, seed):
    path = put(tmp_path / "in" / "a.csv", csv_text(seed))
    rows = read_raw(spark, path, multi_line=True, numbered=True)
    assert rows.columns == ["a", "b", "c", *ORIGIN, ROW_ID]
    got = [(r["a"], r["b"], r["c"]) for r in sorted(rows.collect(), key=lambda r: r[ROW_ID])]
    assert got == by_spark(spark, path)
    assert any(x and "\n" in x for r in got for x in r)


def test_a_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    text = csv_text(1)
    lines = raw_lines(spark, put(tmp_path / "in" / "a.csv", text))
    assert lines.select("block").distinct().count() > 20
    plan = split_records(lines)
    plan.collect()
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    # no window sorts the lines of a whole file
    sorts = [x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in x and "at#" in x]
    assert sorts and all("block#" in x for x in sorts)


def test_records_longer_than_splits_and_open_ends(spark, tmp_path, small_splits):
    long = "line\n" * 100
    text = f'a,b,c\n1,"{long}",x\n2,"{long}{long}",y\n3,,\n\n4,"never closed\n5,6,7\n'
    path = put(tmp_path / "in" / "a.csv", text)
    records = [r["record"] for r in split_records(raw_lines(spark, path)).orderBy("position").collect()]
    assert records == ["a,b,c", f'1,"{long}",x', f'2,"{long}{long}",y', "3,,", '4,"never closed\n5,6,7']


def test_lines_that_do_not_fit(spark, tmp_path, small_splits):
    text = 'a,b,c\n1,"x\ny"\n2,"q\n,r",s,t,u\n3,4,5\n'
    path = put(tmp_path / "in" / "a.csv", text)
    got = read_raw(spark, path, multi_line=True, corrupt=CORRUPT).select("a", "b", "c", CORRUPT).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("1", "x\ny", None, '1,"x\ny"'), ("2", "q\n,r", "s", '2,"q\n,r",s,t,u'), ("3", "4", "5", None)], key=str)


def test_carriage_returns_and_other_separators(spark, tmp_path, small_splits):
    text = 'a;b;c\r\n1;"two\r\nlines; and ""more""";x\r\n2;y, z;"w"\r\n'
    got = read_raw(spark, put(tmp_path / "in" / "a.csv", text), multi_line=True, sep=";").select("a", "b", "c").collect()
    assert sorted(map(tuple, got)) == [("1", 'two\nlines; and "more"', "x"), ("2", "y, z", "w")]


def test_files_with_several_headers(spark, tmp_path, small_splits):
    put(tmp_path / "in" / "a.csv", 'a,b\n1,"x\ny"\n')
    put(tmp_path / "in" / "b.csv", 'b,"long\nname"\n"p\nq",2\n')
    rows = read_raw(spark, str(tmp_path / "in"), multi_line=True)
    assert sorted((tuple(r) for r in rows.select("a", "b", "`long\nname`").collect()), key=str) == sorted([("1", "x\ny", None), (None, "p\nq", "2")], key=str)
    with pytest.raises(ValueError, match="header"):
        read_raw(spark, str(tmp_path / "in"), ["a", "b"], multi_line=True)


def test_the_last_of_equal_keys_in_a_file_still_counts(spark, tmp_path, small_splits):
    """Row identities grow along the files, so the order of answers survives many tasks."""
    body = "".join(f'{k % 7},"note\n{k}"\n' for k in range(60))
    put(tmp_path / "in" / "a.csv", "resp_id,role\n" + body)
    put(tmp_path / "in" / "b.csv", 'resp_id,role\n3,"last\none"\n')
    lake = Lake(str(tmp_path / "lake"), prefix="records")
    run_bronze(spark, lake, str(tmp_path / "in"), 1, multi_line=True)
    last = read_table(spark, lake, "bronze", "answers").groupBy("resp_id").agg(F.max_by("role", ROW_ID).alias("role")).collect()
    assert {r["resp_id"]: r["role"] for r in last} == {**{str(k % 7): f"note\n{k}" for k in range(60)}, "3": "last\none"}


def test_headers_take_one_job(spark, tmp_path):
    """The number of jobs does not grow with the number of files."""
    def jobs(files):
        for i in range(files):
            put(tmp_path / f"in{files}" / f"{i}.csv", ("a,b\n" if i % 3 else "b,c,b\n") + "1,2\n" * 50)
        spark.sparkContext.setJobGroup(f"headers{files}", "")
        found = files_by_header(spark, str(tmp_path / f"in{files}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert {h: len(f) for h, f in found.items()} == {("a", "b"): files - -(-files // 3), ("b0", "c", "b2"): -(-files // 3)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers{files}"))

    few, many = jobs(6), jobs(45)
    assert few == many


def test_header_names_are_those_of_spark(spark, tmp_path):
    for i, header in enumerate(["a,b", 'x,"y, z",', "a,A,b", '"q ""r""",s', "\ufeffk,l"]):
        path = put(tmp_path / f"h{i}.csv", header + "\n" + ",".join("1" * (header.count(",") + 1)) + "\n")
        assert header_names(header) == tuple(spark.read.option("header", True).option("escape", '"').csv(path).columns)
