"""The posts store: idempotent append, keyed write-back, additive schema evolution."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill import schema as S
from postmill.session import checkpoint_dir

# Slices of one source's day when the posts table is written.
SALTS = 16


def keep_first(rows: DataFrame, key: str = "post_id", order: str = "arrival") -> DataFrame:
    """One row per key: the earliest by ``order`` (first writer wins).

    ``min_by`` over a struct is a plain aggregate with a map-side partial step, so
    repeated keys collapse before the shuffle.
    """
    cols = [c for c in rows.columns if c != key]
    picked = rows.groupBy(key).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_r"))
    return picked.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def cap_per_listing(rows: DataFrame, listing: str = "listing", order: str = "arrival",
                    ceiling: int = L.LISTING_CEILING) -> DataFrame:
    """At most ``ceiling`` rows per listing in arrival order (skew-safe top-k per group)."""
    from postmill.operators.topk import top_k_per_group
    return top_k_per_group(rows, listing, [F.col(order)], ceiling, rank_col="_rn").drop("_rn")


def valid(rows: DataFrame) -> DataFrame:
    """Rows the store accepts: non-empty key and the NOT NULL columns present."""
    return rows.where((F.length("post_id") > 0) & F.col("subreddit").isNotNull() & F.col("fetched_at").isNotNull())


def new_rows(store: DataFrame, batch: DataFrame, key: str = "post_id") -> DataFrame:
    """Batch rows whose key is not yet stored (deduplicated, valid, first arrival).

    Stored keys are taken out first, so only new posts are compared by arrival.
    """
    return keep_first(valid(batch).join(store.select(key), key, "left_anti"), key)


def append(store: DataFrame, batch: DataFrame, key: str = "post_id") -> DataFrame:
    """Insert-or-ignore: stored rows never change; only unseen keys are added."""
    add = new_rows(store, batch, key)
    cols = store.columns
    return store.unionByName(add.select(*cols))


def write_back(base: DataFrame, update: DataFrame, key: str = "post_id") -> DataFrame:
    """Keyed update: columns of ``update`` replace those of ``base``; rows missing from
    ``update`` keep their old values (or null when the column is new)."""
    upd_cols = [c for c in update.columns if c != key]
    u = update.select(key, *[F.col(c).alias(f"_new_{c}") for c in upd_cols])
    j = base.join(u, key, "left")
    out = []
    for c in base.columns:
        out.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in upd_cols else F.col(c))
    out += [F.col(f"_new_{c}").alias(c) for c in upd_cols if c not in base.columns]
    return j.select(*out)


def merge(spark, path: str, update: DataFrame, staging: str, part: str, key: str = "post_id") -> list:
    """Keyed update of the stored table at ``path`` (partitioned by ``part``) that rewrites only partitions with a
    row that changes; returns those partitions' values.

    Only the key, partition and updated columns are read to find them. Their new content is staged whole under
    ``staging`` first and then takes the place of the old partitions; files of other partitions are not touched. After a
    failure in between, ``resume`` (which the next ``merge`` calls) finishes the staged work. Columns of ``update`` must be the
    table's; keys that it does not hold are ignored.
    """
    resume(spark, path, staging, part)
    checkpoint_dir(spark)
    # Read twice below; its rows are the key and the updated columns only.
    update = update.checkpoint(eager=True)
    base = spark.read.parquet(path)
    cols = [c for c in update.columns if c != key]
    u = update.select(key, *[F.col(c).cast(base.schema[c].dataType).alias(f"_new_{c}") for c in cols])
    # As in ``write_back``, a null update keeps the old value.
    changed = ~F.lit(True)
    for c in cols:
        changed = changed | (F.col(f"_new_{c}").isNotNull() & ~F.col(f"_new_{c}").eqNullSafe(F.col(c)))
    touched = sorted((r[0] for r in base.select(key, part, *cols).join(u, key).where(changed).select(part).distinct().collect()), key=str)
    if touched:
        here = F.col(part).isin([t for t in touched if t is not None])
        here = here | F.col(part).isNull() if None in touched else here
        write_back(base.where(here), update, key).write.mode("overwrite").partitionBy(part).parquet(staging)
        resume(spark, path, staging, part)
    return touched


def resume(spark, path: str, staging: str, part: str) -> bool:
    """Put completely staged partitions in place and empty the staging table; whether there were any.

    Doing it again after a failure replaces the same partitions by the same rows.
    """
    table = spark.read.parquet(path)
    try:
        staged = spark.read.schema(table.schema).parquet(staging)
    except AnalysisException:  # nothing was ever staged
        return False
    if staged.isEmpty():
        return False
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    table.limit(0).drop(part).write.mode("overwrite").parquet(staging)
    return True


def first_in_order(rows: DataFrame, n: int, order: str = "arrival") -> DataFrame:
    """The first ``n`` rows by ``order`` (a total order), whatever ``n`` is.

    Rows are sorted by range; only the sizes of the ranges come together. Ranges before the cut stay whole, the one at
    the cut keeps its first rows: no task holds the others.
    """
    checkpoint_dir(rows.sparkSession)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    fixed = rows.orderBy(order).withColumn("_part", F.spark_partition_id()).withColumn("_at", at).checkpoint(eager=True)
    left, keep = n, F.lit(False)
    for r in sorted(fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["_part"]):
        if left <= 0:
            break
        keep = keep | ((F.col("_part") == r["_part"]) & (F.col("_at") < left) if r["n"] > left else F.col("_part") == r["_part"])
        left -= r["n"]
    return fixed.where(keep).drop("_part", "_at")


def requested_total(store: DataFrame, batch: DataFrame, n: int, key: str = "post_id") -> DataFrame:
    """The first ``n`` new posts over all listings in arrival order: the rows an ingestion of ``n`` posts adds."""
    return first_in_order(new_rows(store, batch, key), n)


def evolve(frames: list, defaults: dict) -> DataFrame:
    """Union frames with different column sets; missing columns take their defaults."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    for c, v in defaults.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(v))
        elif v is not None:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def read_posts(spark, path: str) -> DataFrame:
    """The posts table at ``path``, in the columns of the schema (sources stay text, whatever their names)."""
    return spark.read.schema(S.POSTS).parquet(path).select(*S.POSTS.fieldNames())


def write_posts(posts: DataFrame, path: str, mode: str = "append") -> None:
    """Store layout for the posts table: one folder per source (partition pruning on the
    source filter) and rows sorted by creation time inside each file (row-group statistics
    skip time ranges). Rows are dealt out by source, day and one of ``SALTS`` slices of a source's day,
    so a hot source's day is not one task."""
    bucket, salt = F.date_trunc("day", F.col("created_utc")), F.pmod(F.xxhash64("post_id"), F.lit(SALTS))
    (posts.repartition("subreddit", bucket, salt)
     .sortWithinPartitions("subreddit", "created_utc")
     .write.mode(mode).partitionBy("subreddit").parquet(path))
