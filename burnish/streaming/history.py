"""Keys of earlier batches, stored so that a batch opens only the files that may hold its keys.

Every batch's new keys are a generation: files by bucket of the key's hash and, for each part of
the hash range, a bitmap with a few bits a key (a blocked Bloom filter made by
``bitmap_construct_agg``).  A generation has as many bitmaps as its keys need, so the share of
false alarms does not depend on its size, and a small one is a single file.  A batch asks the
bitmaps first; what it reads then are the buckets its keys may be in.  Every
``compact_every`` batches the generations since the last time are written together.

Generations are named by batch and found by arithmetic, not by listing: a repeated batch
overwrites its own and reads only earlier ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
BITS = 32_768  # of a bitmap, fixed by Spark's bitmap functions
KEYS_A_MAP = 2_048
PROBES = 3
COMPACT_EVERY = 16

_INDEX = "generation string, bucket int, maps bigint, map bigint, bitmap binary"


class KeyHistory:
    """The keys (columns ``keys``) of all batches handled so far, below ``path``."""

    def __init__(self, path: str, keys: list[str], buckets: int = BUCKETS, compact_every: int = COMPACT_EVERY):
        self.path, self.keys, self.buckets, self.compact_every = path, list(keys), buckets, compact_every
        self.names = [f"_k{i}" for i in range(len(keys))]
        self.opened: list[str] = []  # folders read by the last ``seen``

    def _generations(self, batch_id: int) -> list[str]:
        base = batch_id - batch_id % self.compact_every
        merged = [f"upto-{i}" for i in range(self.compact_every, base + 1, self.compact_every)]
        return merged + [f"batch-{i}" for i in range(base, batch_id)]

    def _placed(self, rows: DataFrame, maps: Column) -> DataFrame:
        """Adds the bitmap, bucket and bits of each key in a generation of ``maps`` bitmaps."""
        hashed = F.xxhash64(*self.names)
        bit = lambda i: F.pmod(F.xxhash64(F.lit(i), F.lit("bit"), *self.names), F.lit(BITS))
        placed = rows.withColumn("maps", maps).withColumn("map", F.pmod(hashed, F.col("maps")))
        return placed.withColumn("bucket", F.pmod("map", F.lit(self.buckets)).cast("int")).withColumn("bits", F.array(*map(bit, range(PROBES))))

    def _write(self, rows: DataFrame, generation: str) -> None:
        """``rows`` holds the key columns under their stored names."""
        maps = 1
        wanted = rows.count() / KEYS_A_MAP
        while maps < wanted:
            maps *= 2
        placed = self._placed(rows, F.lit(maps).cast("bigint"))
        files = placed.select(*self.names, "bucket").repartition(min(maps, self.buckets), "bucket")
        files.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{generation}")
        bits = placed.select("bucket", "maps", "map", F.explode("bits").alias("bit")).groupBy("bucket", "maps", "map").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        bits.select(F.lit(generation).alias("generation"), "bucket", "maps", "map", "bitmap").coalesce(1 + maps // 4096).write.mode("overwrite").parquet(f"{self.path}/index/{generation}")

    def add(self, batch_id: int, rows: DataFrame) -> None:
        """Store the new keys of a batch.  ``rows`` is read more than once: hand in a stored frame."""
        self._write(rows.select(*self.keys).toDF(*self.names), f"batch-{batch_id}")

    def compact(self, batch_id: int, schema: T.StructType) -> None:
        """Merge the generations before ``batch_id``, if it is their turn."""
        if not batch_id or batch_id % self.compact_every:
            return
        spark = SparkSession.active()
        stored = spark.read.schema(self._stored(schema))
        parts = [stored.parquet(f"{self.path}/batch-{i}").select(*self.names) for i in range(batch_id - self.compact_every, batch_id)]
        self._write(reduce(DataFrame.unionByName, parts), f"upto-{batch_id}")

    def _stored(self, schema: T.StructType) -> T.StructType:
        return T.StructType([T.StructField(n, schema[k].dataType) for n, k in zip(self.names, self.keys)])

    def may_hold(self, asked: DataFrame, batch_id: int) -> list[str]:
        """Folders of earlier generations that may hold a key of ``asked``."""
        generations = self._generations(batch_id)
        if not generations:
            return []
        spark = asked.sparkSession
        index = spark.read.schema(_INDEX).parquet(*[f"{self.path}/index/{g}" for g in generations])
        sizes = [r[0] for r in index.select("maps").distinct().collect()]  # powers of two: a few numbers
        if not sizes:
            return []
        named = asked.select(*self.keys).toDF(*self.names)
        spread = named.withColumn("size", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])))
        probes = self._placed(spread, F.col("size")).select("maps", "map", "bits")
        byte = lambda b: F.conv(F.hex(F.expr(f"substring(bitmap, CAST({b} div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
        lit = [F.getbit(byte(f"bits[{i}]"), (F.col("bits")[i] % 8).cast("int")) == 1 for i in range(PROBES)]
        hits = index.join(probes, ["maps", "map"]).filter(reduce(lambda a, b: a & b, lit))
        found = hits.select("generation", "bucket").distinct().collect()  # at most buckets x generations
        return sorted(f"{self.path}/{r.generation}/bucket={r.bucket}" for r in found)

    def seen(self, asked: DataFrame, batch_id: int) -> DataFrame | None:
        """Earlier keys among which those of ``asked`` are, if they were seen (stored names); None if none can."""
        self.opened = self.may_hold(asked, batch_id)
        if not self.opened:
            return None
        return asked.sparkSession.read.schema(self._stored(asked.schema)).parquet(*self.opened)
