"""One job per layer, for ``spark-submit``.

    spark-submit -m surveylake.plans.jobs bronze --lake s3a://b/lake --raw s3a://b/in/3 --batch 3
    spark-submit -m surveylake.plans.jobs silver --lake s3a://b/lake
    spark-submit -m surveylake.plans.jobs gold --lake s3a://b/lake
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from surveylake.operators.technology import explode_tech
from surveylake.plans import cells
from surveylake.plans.fronts import GOLD_TABLES
from surveylake.plans.silver import build_silver, latest_answers
from surveylake.rules import SilverRules
from surveylake.session import get_session
from surveylake.sources.catalog import register
from surveylake.sources.lake import (
    LAYERS, Lake, Table, changed, export_csv, publish, read_parts, read_table, snapshots, stage, tables,
)
from surveylake.sources.raw import CORRUPT, land_bronze, read_raw

_COMMENTS = {
    "answers": "typed, standard answers, one per key",
    "quarantine": "raw rows without a usable key",
    "tech": "one row per answer, category and technology",
}
_EDITION, _NO_EDITION = "edition=", "edition=__HIVE_DEFAULT_PARTITION__"


def run_bronze(
    spark: SparkSession, lake: Lake, raw: str, batch_id: int, multi_line: bool = False,
    sep: str = ",", encoding: str = "UTF-8",
) -> None:
    """Land a delivery whole: all columns of its headers, and lines that do not fit them in a column of their own."""
    rows = read_raw(spark, raw, corrupt=CORRUPT, multi_line=multi_line, sep=sep, encoding=encoding, numbered=True)
    land_bronze(rows, lake, batch_id)
    register(spark, lake, "bronze", "answers", "raw answers, every column text", replace=True)


def _newest(spark: SparkSession, lake: Lake, layer: str) -> int:
    known = snapshots(spark, lake, layer)
    if not known:
        raise ValueError(f"{layer} has no tables yet")
    return known[-1]


def _publish_silver(
    spark: SparkSession, lake: Lake, staged: Sequence[Table], only: Mapping[str, Sequence[str]] | None, csv: bool,
) -> None:
    publish(spark, lake, "silver", staged, only)
    for name, comment in _COMMENTS.items():
        register(spark, lake, "silver", name, comment, replace=True)
    if csv:
        for name in ("answers", "tech"):
            export_csv(read_table(spark, lake, "silver", name), lake.path("silver", f"{name}_csv"))


def _tech(spark: SparkSession, lake: Lake, answers: Table, source: int) -> Table:
    """The technologies of staged answers, by edition like them."""
    rows = explode_tech(read_parts(spark, lake, "silver", answers), keep=("resp_id", "edition"))
    return stage(rows, lake, "silver", "tech", ["edition"], rebalance=False, source=source)


def run_silver(
    spark: SparkSession, lake: Lake, rules: SilverRules = SilverRules(), csv: bool = True
) -> None:
    """All batches to one typed answer per key. The answers are cleaned and written once; the
    technology table and the CSV copy are made from what was written. All three tables change together."""
    source = _newest(spark, lake, "bronze")
    kept, rejected = latest_answers(read_table(spark, lake, "bronze", "answers", source))
    answers = stage(build_silver(kept, rules), lake, "silver", "answers", ["edition"], source=source)
    quarantine = stage(rejected, lake, "silver", "quarantine", ["_batch_id"], source=source)
    _publish_silver(spark, lake, [answers, quarantine, _tech(spark, lake, answers, source)], None, csv)


def _folders(rows: DataFrame) -> list[str]:
    """Partition folders of the editions that occur; as many as the survey has."""
    return [_NO_EDITION if r[0] is None else f"{_EDITION}{r[0]}" for r in rows.select("edition").distinct().collect()]


def refresh_silver(spark: SparkSession, lake: Lake, rules: SilverRules = SilverRules(), csv: bool = True) -> list[str]:
    """Bring silver up to the newest bronze by rewriting only the editions that changed; returns their folders.

    The batches that changed since silver was made are known from the snapshots, so nothing is
    forgotten when a job dies between two layers. Their keys, in the old and in the new files, are
    the touched ones: answers with such a key are made anew from all batches, all others are kept as
    they stand. Which copy of an answer counts is thus decided as in a full run. Silver is
    rebuilt whole where it has no known source, that source is gone, or the columns differ.
    """
    source = _newest(spark, lake, "bronze")
    found = tables(spark, lake, "silver")
    answers = found.get("answers")
    if answers is None or set(_COMMENTS) - set(found) or answers.source not in snapshots(spark, lake, "bronze"):
        run_silver(spark, lake, rules, csv)
        return sorted(tables(spark, lake, "silver")["answers"].versions)
    old, new = (tables(spark, lake, "bronze", n)["answers"] for n in (answers.source, source))
    batches = changed(old, new)
    if not batches:
        return []
    keys = [latest_answers(read_parts(spark, lake, "bronze", t, batches))[0].select("resp_id") for t in (old, new)]
    touched = keys[0].union(keys[1]).distinct().persist()
    bronze = read_table(spark, lake, "bronze", "answers", source)
    # a key is compared in its typed form, as in the silver layer
    typed = F.trim(F.col("resp_id").cast("string")).try_cast("bigint")
    kept, _ = latest_answers(bronze.join(touched.withColumnRenamed("resp_id", "_key"), typed == F.col("_key"), "left_semi"))
    fresh = build_silver(kept, rules).persist()
    if sorted(fresh.dtypes) != sorted((f.name, f.dataType.simpleString()) for f in answers.schema):
        run_silver(spark, lake, rules, csv)
        return sorted(tables(spark, lake, "silver")["answers"].versions)
    stored = read_parts(spark, lake, "silver", answers)
    editions = sorted({*_folders(stored.join(touched, "resp_id", "left_semi")), *_folders(fresh)})
    others = read_parts(spark, lake, "silver", answers, editions).join(touched, "resp_id", "left_anti")
    rewritten = stage(others.unionByName(fresh), lake, "silver", "answers", ["edition"], source=source)
    _, rejected = latest_answers(read_parts(spark, lake, "bronze", new, batches))
    quarantine = stage(rejected, lake, "silver", "quarantine", ["_batch_id"], source=source)
    only = {"answers": editions, "tech": editions, "quarantine": batches}
    _publish_silver(spark, lake, [rewritten, quarantine, _tech(spark, lake, rewritten, source)], only, csv)
    for df in (touched, fresh):
        df.unpersist()
    return editions


def _publish_gold(spark: SparkSession, lake: Lake, stored: Mapping[str, Table], names: Sequence[str], only: Mapping, source: int) -> None:
    """Gold tables from cells, some of them staged just now; all change together."""
    staged = list(stored.values())
    before = tables(spark, lake, "gold")

    def read(name: str) -> DataFrame:
        rows = read_parts(spark, lake, "gold", stored[name])
        if name not in only:
            return rows
        rest = [f for f in before[name].versions if f not in set(only[name])]
        return rows.unionByName(read_parts(spark, lake, "gold", before[name], rest))

    made = [stage(cells.from_cells(name, read), lake, "gold", name, source=source) for name in names]
    publish(spark, lake, "gold", [*staged, *made], only)
    for t in [*staged, *made]:
        register(spark, lake, "gold", t.name, replace=True)


def run_gold(
    spark: SparkSession, lake: Lake, names: Sequence[str] | None = None
) -> None:
    """All gold tables, or some, from the counts of all editions: silver is read once per family of counts that they need."""
    source, names = _newest(spark, lake, "silver"), list(names or GOLD_TABLES)
    answers = read_table(spark, lake, "silver", "answers", source)
    stored = {f: stage(cells.stored(answers, f), lake, "gold", f, ["edition"], source=source) for f in cells.needed(names)}
    _publish_gold(spark, lake, stored, names, {}, source)


def refresh_gold(spark: SparkSession, lake: Lake) -> list[str]:
    """Bring the gold tables there are up to the newest silver, all of them if there are none.

    Only changed editions are counted again; returns their folders.
    """
    source, found = _newest(spark, lake, "silver"), tables(spark, lake, "gold")
    names = [n for n in GOLD_TABLES if n in found] or list(GOLD_TABLES)
    kept = cells.needed(names)
    made = {found[n].source if n in found else None for n in (*kept, *names)}
    if len(made) != 1 or not made <= set(snapshots(spark, lake, "silver")):
        run_gold(spark, lake, names)
        return sorted(tables(spark, lake, "silver", source)["answers"].versions)
    old, new = (tables(spark, lake, "silver", n)["answers"] for n in (made.pop(), source))
    editions = changed(old, new)
    if editions:
        answers = read_parts(spark, lake, "silver", new, editions)
        stored = {f: stage(cells.stored(answers, f), lake, "gold", f, ["edition"], source=source) for f in kept}
        _publish_gold(spark, lake, stored, names, {f: editions for f in kept}, source)
    return editions


def run_layer(spark: SparkSession, lake: Lake, layer: str, **options) -> None:
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
    {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}[layer](spark, lake, **options)


def reprocess(spark: SparkSession, lake: Lake, batches: Mapping[int, str], **silver) -> list[str]:
    """Land batches again from their raw folders and bring silver and gold up to them; returns the editions rewritten.

    Only editions with an answer that the batches touch get new files, and only
    those are counted again. The result equals a full rebuild. Running it twice, or again after
    a job that died on the way, gives the same tables.
    """
    for batch_id, raw in batches.items():
        run_bronze(spark, lake, raw, batch_id)
    editions = refresh_silver(spark, lake, **silver)
    refresh_gold(spark, lake)
    return editions


def main(args: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one layer of the survey lake.")
    parser.add_argument("layer", choices=LAYERS)
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--raw", help="folder of raw files (bronze)")
    parser.add_argument("--batch", type=int, help="number of the batch (bronze)")
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quotes")
    parser.add_argument("--sep", default=",", help="separator of the raw files")
    parser.add_argument("--encoding", default="UTF-8", help="encoding of the raw files")
    given = parser.parse_args(args)
    options = {}
    if given.layer == "bronze":
        if given.raw is None or given.batch is None:
            parser.error("bronze needs --raw and --batch")
        options = {"raw": given.raw, "batch_id": given.batch, "multi_line": given.multi_line,
                   "sep": given.sep, "encoding": given.encoding}
    spark = get_session(f"surveylake-{given.layer}")
    run_layer(spark, Lake(given.lake), given.layer, **options)


if __name__ == "__main__":
    main()
