"""Index of the keys of a store, so that an insert-or-ignore reads only what its batch may collide with.

Keys lie in folders by hash bucket, and each bucket has a Bloom filter (rows of 64-bit words, or-ed together when
read). A batch first asks the filters of the buckets it touches; only buckets where some key may be stored are read,
and only by their keys. A batch of unseen keys reads no key at all. A filter that has filled up costs reads, never results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.session import checkpoint_dir

BUCKETS = 64
# Bits of a bucket's filter and bits set by a key: under 1 % false alarms up to 100,000 keys a bucket.
BLOOM_BITS, HASHES = 1 << 20, 5


def bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _words(keys: DataFrame, key: str) -> DataFrame:
    """(bucket, key, word, bit): the places of each key in its bucket's filter."""
    slots = F.transform(F.sequence(F.lit(1), F.lit(HASHES)), lambda s: F.pmod(F.xxhash64(F.col(key), s), F.lit(BLOOM_BITS)))
    d = keys.select("bucket", key, F.explode(slots).alias("slot"))
    return d.select("bucket", key, F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))


class KeyIndex:
    """The index at ``path`` (``keys`` and ``bloom`` below it) of the text keys in column ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "post_id"):
        self.spark, self.key = spark, key
        self.keys_path, self.bloom_path = f"{path}/keys", f"{path}/bloom"
        # Buckets whose keys the last look-up read.
        self.read: list[int] = []

    def build(self, keys: DataFrame) -> None:
        """Replace the index by one of ``keys`` (with column ``key``, distinct)."""
        self._write(keys, "overwrite")

    def add(self, keys: DataFrame) -> None:
        """Add distinct keys that the index does not hold."""
        self._write(keys, "append")

    def _write(self, keys: DataFrame, mode: str) -> None:
        k = keys.select(bucket(self.key).alias("bucket"), self.key)
        k.repartition("bucket").write.mode(mode).partitionBy("bucket").parquet(self.keys_path)
        bits = _words(k, self.key).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))
        bits.repartition("bucket").sortWithinPartitions("bucket", "word").write.mode(mode).partitionBy("bucket").parquet(self.bloom_path)

    def _table(self, path: str, schema: str, buckets: list[int]) -> DataFrame:
        return self.spark.read.schema(f"{schema}, bucket int").parquet(path).where(F.col("bucket").isin(buckets))

    def stored(self, keys: DataFrame) -> DataFrame:
        """The distinct keys of ``keys`` that the index holds, as (key); reads the buckets in ``self.read`` only."""
        checkpoint_dir(self.spark)
        k = keys.select(bucket(self.key).alias("bucket"), self.key).distinct().checkpoint(eager=True)
        touched = [r[0] for r in k.select("bucket").distinct().collect()]
        bloom = self._table(self.bloom_path, "word bigint, bits bigint", touched).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        hit = F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False))
        maybe = (_words(k, self.key).join(bloom, ["bucket", "word"], "left").groupBy("bucket", self.key)
                 .agg(F.min(hit).alias("maybe")).where("maybe").drop("maybe")).checkpoint(eager=True)
        self.read = sorted(r[0] for r in maybe.select("bucket").distinct().collect())
        held = self._table(self.keys_path, f"{self.key} string", self.read)
        return held.join(maybe, ["bucket", self.key], "left_semi").select(self.key)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose key the index does not hold."""
        return batch.join(self.stored(batch), self.key, "left_anti")
