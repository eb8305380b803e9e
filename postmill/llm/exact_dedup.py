"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Rows that no other row equals in length and prefix hash are settled by the first pass; the full
text is hashed only for the surviving groups. The survivors reach the second scan as a bitmap of
fixed size, so no text is ever shuffled: a false positive of the bitmap costs one more hash and
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import ascii_lower, bitmap, cut, flagged, row_key, settle, text_or_empty

PREFIX_CHARS = 64


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, digest).

    Texts are equal when they are identical after lower-casing A-Z (null counts as empty). Of
    equal texts the row with the largest id stays; of rows equal in id and text exactly one stays.
    A null id is smaller than any other. ``digest`` is the SHA-256 of the normalised text; it is
    null for rows that length and prefix settled, unless ``digest_all``. Empty input: no rows.
    """
    t = ascii_lower(text_or_empty(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text_or_empty(text_col)).alias("len"),
                       F.xxhash64(ascii_lower(F.substring(text_or_empty(text_col), 1, PREFIX_CHARS))).alias("pre"),
                       t.alias("t"))
    # Levels 1 and 2: groups of equal length and prefix hash. Narrow rows, combined before the shuffle.
    groups = rows.groupBy("len", "pre").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Level 3: full hashes of the survivors.
    r = flagged(rows, bitmap(groups, "len", "pre"), "len", "pre", name="alive")
    alive = F.col("alive")
    digest = F.sha2("t", 256)
    r = r.select("id", "alive", (digest if digest_all else F.when(alive, digest)).alias("digest"))
    r = cut(r)
    one = r.where(~F.col("alive")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                          F.lit(True).alias("kept"), "digest")
    # Equal rows are counted first, so a group of copies is as large as its distinct ids.
    ids = r.where("alive").groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"))
    sizes = ids.groupBy(F.col("digest").alias("g")).agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    many = ids.join(sizes, F.col("digest") == F.col("g"))
    many = many.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    many = many.select("id", "keep_id", "group_size",
                       (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest")
    return one.unionByName(many).withColumnRenamed("id", id_col)


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    d = exact_dedup(keyed, "key", "text").groupBy("key").agg(F.max("kept").alias("keep"), F.count(F.lit(1)).alias("n"))
    return settle(docs, d.where("not keep or n > 1"), id_col, text_col)
