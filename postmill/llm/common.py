"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words are runs of anything but space and the ASCII control blanks.
BLANKS = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; all other characters stay."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Bits of a bitmap of keys: 2^22 bits are at most 65,536 rows of (word, bits), 1 MB, whatever the input.
BITMAP_BITS = 1 << 22


def slot(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(BITMAP_BITS))


def bitmap(keys: DataFrame, *cols: str) -> DataFrame:
    """(word, bits): a bitmap of the hashed keys, of fixed size; it holds every key, and perhaps others."""
    s = keys.select(slot(*cols).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    return cut(s.select(F.shiftright("slot", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")))


def flagged(df: DataFrame, bits: DataFrame, *cols: str, name: str = "__llm_maybe") -> DataFrame:
    """``df`` with a flag: whether the bitmap may hold the row's key. The bitmap is broadcast; no row moves."""
    d = df.withColumn("__llm_slot", slot(*cols))
    b = F.broadcast(bits.select(F.col("word").alias("__llm_word"), F.col("bits").alias("__llm_bits")))
    d = d.join(b, F.shiftright("__llm_slot", 6) == F.col("__llm_word"), "left")
    on = F.coalesce(F.expr("(shiftright(__llm_bits, cast(__llm_slot & 63 as int)) & 1) = 1"), F.lit(False))
    return d.withColumn(name, on).drop("__llm_slot", "__llm_word", "__llm_bits")


def row_key(id_col: str, text_col: str) -> Column:
    """What identifies a row in a decision: its id and its text (rows equal in both get the same decision)."""
    return F.struct(F.col(id_col).alias("id"), F.sha2(text_or_empty(text_col), 256).alias("digest"))


def settle(docs: DataFrame, decisions: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` after decisions (key, keep) that change something: kept keys stay once, the others go.

    Rows without a decision stay as they are. Rows that no decision can concern are told by a bitmap of the
    keys and are not moved; only the others meet the decisions in a join.
    """
    d = cut(decisions.select(F.col("key.id").alias("__llm_d_id"), F.col("key.digest").alias("__llm_d_text"), F.col("keep").alias("__llm_d_keep")).distinct())
    keyed = docs.withColumn("__llm_key", row_key(id_col, text_col)).withColumn("__llm_digest", F.col("__llm_key.digest"))
    keyed = flagged(keyed, bitmap(d, "__llm_d_text"), "__llm_digest")
    rest = keyed.where(~F.col("__llm_maybe"))
    cond = (F.col("__llm_digest") == F.col("__llm_d_text")) & F.col("__llm_key.id").eqNullSafe(F.col("__llm_d_id"))
    met = keyed.where("__llm_maybe").join(d, cond, "left")
    open_ = met.where(F.col("__llm_d_keep").isNull())
    once = met.where("__llm_d_keep").dropDuplicates(["__llm_key"])
    return rest.select(*docs.columns).unionByName(open_.select(*docs.columns)).unionByName(once.select(*docs.columns))
