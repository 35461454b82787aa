"""Two-pass external shuffle into shards of equal row counts.

Pass 1 scatters rows into buckets by a seeded hash; the number of buckets follows
from the bytes of the input, so a bucket fits in one task's memory at any scale.
Pass 2 sorts a bucket (so a retried task sees the same order), shuffles it by
Fisher-Yates with a generator seeded by bucket, and writes it. Global places are
bucket offset + place in the bucket; shards are equal ranges of places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.llm.common import save, scratch

#: Rows get these columns; columns of the input with the same names are replaced.
PLACES = ("shard", "slot")


def _shuffled(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                table = pa.Table.from_batches(held)
                order = np.random.default_rng((seed, current)).permutation(table.num_rows)
                table = table.take(order).append_column("_place", pa.array(np.arange(table.num_rows), pa.int64()))
                held.clear()
                yield from table.to_batches(max_chunksize=2_000)

        for batch in batches:
            buckets = batch.column("_bucket").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1), len(buckets)]
            for start, end in zip(edges, edges[1:]):
                if end > start:
                    if buckets[start] != current:
                        yield from flush()
                        current = int(buckets[start])
                    held.append(batch.slice(start, end - start))
        yield from flush()

    return run


def shuffle_into_shards(df: DataFrame, key: str, text: str, shards: int, *, seed: int = 0, bucket_bytes: int = 32 << 20) -> DataFrame:
    """Rows of ``df`` in random order with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in each shard).

    The counts of any two shards differ by one at most. Every row stays, repeated
    rows, NULL keys and NULL texts too; an empty table gives an empty one. Rows that
    agree in key and text are alike and may change places. Python holds one bucket
    at a time, about three times ``bucket_bytes``; one row that is longer is a
    bucket of its own size.
    """
    spark = df.sparkSession
    df = df.drop(*PLACES, "_bucket", "_place", "_rows", "_before")
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 8
    total = df.select(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), key, text), F.lit(buckets)).cast("int")

    counts = df.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows"))
    # One row per bucket: input bytes / bucket_bytes.
    offsets = save(counts.withColumn("_before", F.sum("_rows").over(Window.orderBy("_bucket")) - F.col("_rows")))
    rows = offsets.select(F.sum("_rows")).first()[0] or 0

    scattered = df.withColumn("_bucket", bucket).repartitionById(buckets, F.col("_bucket")).sortWithinPartitions("_bucket", key, text)
    schema = T.StructType([*scattered.schema.fields, T.StructField("_place", T.LongType())])
    placed = scattered.mapInArrow(_shuffled(seed), schema).join(offsets, "_bucket")

    place = F.col("_before") + F.col("_place")
    least, longer = divmod(rows, shards)  # the first `longer` shards hold one row more
    edge = longer * (least + 1)
    shard = F.when(place < edge, place.cast("long") / (least + 1)).otherwise(longer + (place - edge) / max(least, 1))
    shard = F.floor(shard).cast("int")
    slot = F.when(place < edge, place % (least + 1)).otherwise((place - edge) % max(least, 1))
    return placed.select(*df.columns, shard.alias("shard"), slot.alias("slot"))


def write_shards(df: DataFrame, key: str, text: str, shards: int, **options) -> DataFrame:
    """Writes the shuffled rows as one folder per shard and returns the written table."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    placed = shuffle_into_shards(df, key, text, shards, **options).sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)
