"""Merkle manifest of a dataset, its upper proofs found by a butterfly exchange.

Leaves are numbered within their group and cut into aligned blocks of
``fanout ** HEIGHT``; a block's task hashes its own subtree. Then, round by round,
aligned runs of ``fanout`` groups of blocks swap the roots of their subtrees: every
block asks one block of each sibling group, takes their roots into its proof and
hashes the common ancestor itself. After the last round every block holds the root and
all upper siblings, so nothing is sent down. Subroots of the groups are the leaves of a
second tree of the same kind.

Odd input: a NULL field is hashed as ``-``; rows of one id follow each other by leaf hash;
a NULL id comes first and is never tampered with; equal rows get a leaf each; an
empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.llm.common import save

FANOUT = 3
#: Levels that one task hashes by itself: a block has at most fanout ** HEIGHT leaves.
HEIGHT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def levels(leaves: int, fanout: int) -> int:
    """Levels above the leaves: one remains after them."""
    found = 0
    while leaves > 1:
        leaves, found = -(-leaves // fanout), found + 1
    return found


def field(value: Column) -> Column:
    """``-`` for NULL, else the length in bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column, fields: Sequence[str] = FIELDS) -> Column:
    """The leaf hash of a row, with ``text`` in place of its text."""
    return F.sha2(F.concat(*[field(text if f == "text" else F.col(f)) for f in fields]), 256)


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``idx`` within ``g`` by ``order``, and ``total``, the number of nodes of ``g``; a hot group is spread over all tasks."""
    spread = nodes.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    spread = save(spread.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    runs = spread.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy("g")
    runs = runs.select("g", "part", (F.sum("n").over(group.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(group).alias("total"))
    return spread.join(runs, ["g", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def tree(hashes: list[str], height: int, fanout: int) -> tuple[list[str], str]:
    """The proof of each leaf up to ``height`` levels, and the node there.

    A level of a proof is the place in the run, a colon, and the siblings; levels are separated by commas.
    """
    proofs: list[list[str]] = [[] for _ in hashes]
    level, width = hashes, 1
    for _ in range(height):
        runs = [level[i:i + fanout] for i in range(0, len(level), fanout)]
        for node in range(len(level)):
            run, place = runs[node // fanout], node % fanout
            shown = f"{place}:{''.join(run[:place] + run[place + 1:])}"
            for at in range(node * width, min((node + 1) * width, len(hashes))):
                proofs[at].append(shown)
        level, width = [digest(run) for run in runs], width * fanout
    return [",".join(p) for p in proofs], level[0]


def _blocks(height: int, fanout: int) -> Callable:
    def hashed(key: tuple, total: int, rows: list[tuple]) -> pa.RecordBatch:
        proofs, top = tree([r[1] for r in rows], min(height, levels(total, fanout)), fanout)
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array([total] * n, pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
             pa.array(proofs), pa.array([top] + [None] * (n - 1), pa.string())],
            ["g", "block", "total", "row", "low", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, of, rows = None, 0, []
        for batch in batches:
            for g, block, total, row, node in zip(*[batch.column(c).to_pylist() for c in ("g", "block", "total", "row", "hash")]):
                if (g, block) != key:
                    if rows:
                        yield hashed(key, of, rows)
                    key, of, rows = (g, block), total, []
                rows.append((row, node))
        if rows:
            yield hashed(key, of, rows)

    return run


def exchange(blocks: DataFrame, distance: int, fanout: int) -> DataFrame:
    """One round: blocks ``distance`` apart swap the roots of their subtrees and hash their ancestor, each for itself."""
    child = F.expr(f"block div {distance}")
    newest = F.expr(f"last div {distance}")
    start = F.expr(f"block div {distance * fanout} * {fanout}")
    open_ = blocks.where(F.col("last") >= distance).withColumn("child", child)
    asked = open_.select("g", "block", "last", "child", F.explode(F.sequence(start, F.least(start + fanout - 1, newest))).alias("place")).where("place <> child")
    base = F.col("place") * distance
    # The partner in the sibling group: the same place in it, or, where that group is cut short, one of those there are.
    partner = base + F.col("block") % distance % F.least(F.lit(distance), F.col("last") - base + 1)
    answers = asked.select("g", "block", "place", partner.alias("partner")).join(
        blocks.select("g", F.col("block").alias("partner"), "node"), ["g", "partner"])
    got = answers.groupBy("g", "block").agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias("others"))
    none = F.array().cast("array<struct<place:bigint,node:string>>")
    joined = open_.join(got, ["g", "block"], "left").withColumn("others", F.coalesce("others", none))
    run = F.array_sort(F.concat("others", F.array(F.struct(F.col("child").alias("place"), "node"))))
    nodes = lambda a: F.array_join(F.transform(a, lambda x: x["node"]), "")
    shown = F.concat(F.lit(","), (F.col("child") % fanout).cast("string"), F.lit(":"), nodes(F.col("others")))
    done = joined.select("g", "block", "last", F.sha2(nodes(run), 256).alias("node"), F.concat("high", shown).alias("high"))
    return done.unionByName(blocks.where(F.col("last") < distance))


def prove(nodes: DataFrame, order: Sequence[str], fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """(g, row, proof, top): each node's siblings, level by level, and the root of its group ``g``.

    ``nodes`` has ``g`` (not NULL), ``row`` (a number of its own), ``hash`` and the columns of ``order``.
    """
    size = fanout ** height
    spread = numbered(nodes, order).select("g", "row", "hash", "total", "idx", F.expr(f"idx div {size}").alias("block"))
    spread = spread.repartition("g", "block").sortWithinPartitions("g", "block", "idx").select("g", "block", "total", "row", "hash")
    low = save(spread.mapInArrow(_blocks(height, fanout), "g string, block long, total long, row long, low string, top string"))
    blocks = low.where("top IS NOT NULL").select("g", "block", F.expr(f"(total - 1) div {size}").alias("last"), F.col("top").alias("node"), F.lit("").alias("high"))
    blocks, distance = save(blocks), 1
    furthest = blocks.agg(F.max("last")).first()[0] or 0
    while distance <= furthest:
        blocks, distance = save(exchange(blocks, distance, fanout)), distance * fanout
    return low.join(blocks, ["g", "block"]).select("g", "row", F.concat("low", "high").alias("proof"), F.col("node").alias("top"))


def folded(node: str, proof: str) -> str:
    """The root that follows from a leaf and its proof."""
    for level in filter(None, proof.split(",")):
        place, _, others = level.partition(":")
        at = 64 * int(place)
        node = digest((others[:at], node, others[at:]))
    return node


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proofs = batch.column("proof").to_pylist()
        siblings = ["".join(level.partition(":")[2] for level in p.split(",")) for p in proofs]
        roots = [folded(node, p) for node, p in zip(batch.column("shown").to_pylist(), proofs)]
        out = {"proof_sha256": pa.array([digest((s,)) for s in siblings], pa.string()), "folded_root": pa.array(roots, pa.string())}
        names = [n for n in batch.schema.names if n != "shown"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *out.values()], [*names, *out])


def manifest(docs: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, again, subroot, root, proof) per row of ``docs``.

    ``again`` is the leaf as it would be without the line breaks of the text, where the
    checksum of the id is even, and else the leaf itself: a document that was tampered with.
    """
    docs = docs.select(*[F.col(f) for f in FIELDS])
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    bare = F.when(even, F.translate(F.col("text").cast("string"), "\n", "")).otherwise(F.col("text").cast("string"))
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = save(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", source.alias("g"), leaf(F.col("text")).alias("hash"), leaf(bare).alias("again")))
    proofs = save(prove(rows.select("g", "row", "hash", "doc_id"), ["doc_id", "hash", "row"], fanout, height))
    subroots = save(proofs.groupBy("g").agg(F.first("top").alias("hash")).withColumn("row", F.monotonically_increasing_id()))
    upper = prove(subroots.select(F.lit("").alias("g"), F.col("g").alias("source"), "row", "hash"), ["source"], fanout, height)
    upper = subroots.select("g", "row").join(upper.select("row", F.col("proof").alias("over"), F.col("top").alias("root")), "row").drop("row")
    joint = F.when((F.col("proof") == "") | (F.col("over") == ""), "").otherwise(",")
    whole = rows.join(proofs.drop("g"), "row").join(upper, "g")
    return whole.select(
        "doc_id", F.col("hash").alias("leaf"), "again", F.col("top").alias("subroot"), "root", F.concat("proof", joint, "over").alias("proof"))


def verified(rows: DataFrame) -> DataFrame:
    """``rows`` of ``manifest``, with ``proof_sha256``, ``folded_root`` (from ``again`` and the proof) and ``verified``."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{n} {t}" for n, t in types.items()) + ", proof_sha256 string, folded_root string"
    out = rows.withColumn("shown", F.col("again")).mapInArrow(_verify, schema)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
