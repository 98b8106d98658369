"""An index of the keys of a stored table: hash buckets with a Bloom filter each.

``generations`` of keys are added by appends. Each has its keys in folders by bucket, and the
Bloom filters of its buckets, cut into blocks of 4 KB that one key sets bits of. A batch is
asked in three steps: its keys find the blocks they would be in; those whose bits are all set
may be stored; only the buckets of these are read. A batch of new keys reads filters of its
own buckets and hardly any keys, however large the table is.

A generation counts once it is finished. ``pending`` ones are of appends that did not end.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickertide.session import cut_lineage
from tickertide.sources.files import names, put_file

BUCKETS = 16  # at least
KEYS_PER_BUCKET = 1 << 20  # when the index is made
BLOCK_BITS = 32768  # the size of Spark's bitmaps
BITS_SET = 4
KEYS_PER_BLOCK = 2048  # 16 bits a key, so some 3 keys in 1000 pass by chance

KEYS = "key string"
FILTERS = "block bigint, bits binary"


class KeyIndex:
    """Index of string keys below ``path``.

    The number of buckets is fixed by the first generation, from its size or ``buckets``.
    One writer at a time; readers may come at any time. Null keys are not stored, and asking
    for them finds nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        # Whether each generation is done and dropped, and the blocks of its buckets; there are
        # as many generations as appends since the last ``compact``.
        self._states: dict[str, tuple[bool, bool, int]] = {}
        marks = [name.split("-") for name in names(spark, f"{path}/log")]
        for mark in marks:
            if mark[1] == "begun":
                self.buckets = int(mark[2])
                states = {m[1] for m in marks if m[0] == mark[0]}
                self._states[mark[0]] = ("done" in states, "dropped" in states, int(mark[3]))

    def _placed(self, keys: DataFrame) -> DataFrame:
        first = F.xxhash64("key")
        return keys.withColumns({
            "bucket": F.pmod(first, F.lit(self.buckets)).cast("int"), "_spread": F.shiftright(first, 16), "_bits": F.xxhash64(F.lit(1), "key"),
        })

    @staticmethod
    def _positions() -> Column:
        return F.array(*[F.shiftright("_bits", 15 * i).bitwiseAND(BLOCK_BITS - 1) for i in range(BITS_SET)])

    def generations(self) -> list[str]:
        return sorted(g for g, (done, dropped, _) in self._states.items() if done and not dropped)

    def pending(self) -> list[str]:
        return sorted(g for g, (done, dropped, _) in self._states.items() if not done and not dropped)

    def exists(self) -> bool:
        return bool(self._states)

    def _say(self, generation: str, state: str, blocks: int = 0) -> None:
        """Leave a mark: an empty file whose name says it all."""
        made = f"-{self.buckets}-{blocks}" if state == "begun" else ""
        put_file(self.spark, f"{self.path}/log/{generation}-{state}{made}", b"")
        old = self._states.get(generation, (False, False, blocks))
        self._states[generation] = (old[0] or state == "done", old[1] or state == "dropped", old[2])

    def keys(self, generations: list[str], buckets: list[int] | None = None) -> DataFrame:
        """Stored keys with their bucket, of some buckets or all."""
        if not generations:
            return self.spark.createDataFrame([], f"{KEYS}, bucket int")
        reader = self.spark.read.schema(f"{KEYS}, generation string, bucket int").option("basePath", f"{self.path}/keys")
        rows = reader.parquet(*[f"{self.path}/keys/generation={g}" for g in generations])
        return (rows if buckets is None else rows.where(F.col("bucket").isin(buckets))).select("key", "bucket")

    def add(self, keys: DataFrame, n: int | None = None) -> str:
        """Write keys (``key``) as a generation, which counts when ``finish`` is called. With
        ``n`` they are a table or checkpoint of that many different keys."""
        name = uuid.uuid4().hex
        if n is None:
            counted = Observation()
            keys = cut_lineage(keys.where("key is not null").distinct().observe(counted, F.count("*").alias("n")))
            n = counted.get["n"]
        if self.buckets is None:
            self.buckets = max(BUCKETS, 1 << (n // KEYS_PER_BUCKET).bit_length())
        blocks = 1 << (n // self.buckets // KEYS_PER_BLOCK).bit_length()
        self._say(name, "begun", blocks)
        rows = self._placed(keys)
        rows.select("key", "bucket").hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{self.path}/keys/generation={name}")
        block = F.pmod("_spread", F.lit(blocks)).alias("block")
        bits = rows.select("bucket", block, F.explode(self._positions()).alias("at")).groupBy("bucket", "block").agg(F.bitmap_construct_agg("at").alias("bits"))
        bits.write.partitionBy("bucket").parquet(f"{self.path}/filters/generation={name}")
        return name

    def finish(self, *generations: str) -> None:
        for name in generations:
            self._say(name, "done")

    def drop(self, *generations: str) -> None:
        for name in generations:
            self._say(name, "dropped")

    def possible(self, keys: DataFrame) -> DataFrame:
        """Of ``key`` those that the filters do not rule out, with their bucket. ``keys`` is
        read twice."""
        asked = self._placed(keys.where("key is not null"))
        live = self.generations()
        if not live:
            return asked.select("key", "bucket").where(F.lit(False))
        wanted = [r.bucket for r in asked.select("bucket").distinct().collect()]  # no more than buckets
        reader = self.spark.read.schema(f"{FILTERS}, generation string, bucket int").option("basePath", f"{self.path}/filters")
        filters = reader.parquet(*[f"{self.path}/filters/generation={g}" for g in live]).where(F.col("bucket").isin(wanted))
        # A generation's number of blocks is a power of two, so there are few different ones.
        sizes: dict[int, list[str]] = {}
        for g in live:
            sizes.setdefault(self._states[g][2], []).append(g)

        def is_set(at: Column) -> Column:
            byte = F.conv(F.hex(F.substring("bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            return F.pmod(F.floor(byte / F.pow(F.lit(2), at.bitwiseAND(7))), F.lit(2)) == 1

        hit = reduce(Column.__and__, [is_set(F.get(self._positions(), i)) for i in range(BITS_SET)])
        parts = [
            asked.withColumn("block", F.pmod("_spread", F.lit(size)))
            .join(filters.where(F.col("generation").isin(names)), ["bucket", "block"]).where(hit).select("key", "bucket")
            for size, names in sizes.items()
        ]
        return reduce(DataFrame.unionByName, parts).distinct()

    def stored(self, keys: DataFrame) -> DataFrame:
        """Of ``key`` those that are stored, each once. Reads only buckets that may hold one;
        ``keys`` is read twice."""
        if not self.generations():
            return keys.select("key").where(F.lit(False))
        maybe = cut_lineage(self.possible(keys))
        buckets = [r.bucket for r in maybe.select("bucket").distinct().collect()]
        return maybe.select("key").join(self.keys(self.generations(), buckets).select("key"), "key", "left_semi")

    def compact(self) -> None:
        """Join the finished generations to one."""
        old = self.generations()
        if len(old) > 1:
            self.finish(self.add(self.keys(old).select("key")))
            self.drop(*old)
