"""Landed listing pages (JSON envelopes) -> post rows.

A listing page is ``{"data": {"after": ..., "children": [{"kind": "t3", "data": {...}}]}}``.
Pages are read with an explicit schema (no inference), children are exploded with
their position, and only ``t3`` children are posts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill import schema as S
from postmill.functions import text as TX


def children(pages: DataFrame) -> DataFrame:
    """Unwrap envelopes: one row per ``t3`` child, with its page position.

    A missing envelope or empty children list yields no rows.
    """
    keep = [c for c in pages.columns if c != "data"]
    kids_type = S.LISTING["data"].dataType["children"].dataType.simpleString()
    kids = F.coalesce(F.col("data.children"), F.array().cast(kids_type))
    ex = pages.select(*keep, F.col("data.after").alias("after"), F.posexplode(kids).alias("position", "child"))
    return ex.where(F.col("child.kind") == "t3").select(*keep, "after", "position", F.col("child.data").alias("raw"))


def project(raw: Column, fetched_at: Column) -> list:
    """One listing child -> posts columns, with the defaults of the original projection."""
    created = F.timestamp_seconds(F.coalesce(raw["created_utc"], F.lit(0.0))).cast("timestamp_ntz")
    return [
        F.coalesce(raw["id"], F.lit("")).alias("post_id"),
        F.coalesce(raw["subreddit"], F.lit("")).alias("subreddit"),
        TX.light_clean(raw["title"]).alias("title"),
        F.coalesce(raw["author"], F.lit("[deleted]")).alias("author"),
        F.coalesce(raw["score"], F.lit(0).cast("bigint")).alias("score"),
        F.coalesce(raw["upvote_ratio"], F.lit(0.0)).alias("upvote_ratio"),
        F.coalesce(raw["num_comments"], F.lit(0).cast("bigint")).alias("num_comments"),
        created.alias("created_utc"),
        F.coalesce(raw["url"], F.lit("")).alias("url"),
        F.concat(F.lit(L.PERMALINK_PREFIX), F.coalesce(raw["permalink"], F.lit(""))).alias("permalink"),
        TX.light_clean(raw["selftext"]).alias("selftext"),
        F.coalesce(raw["is_self"], F.lit(False)).alias("is_self"),
        F.coalesce(raw["over_18"], F.lit(False)).alias("over_18"),
        F.coalesce(raw["link_flair_text"], F.lit("")).alias("flair"),
        F.coalesce(raw["domain"], F.lit("")).alias("domain"),
        fetched_at.alias("fetched_at"),
    ]


def to_posts(pages: DataFrame, arrival_cols=("fetched_at", "listing", "page")) -> DataFrame:
    """Pages -> post rows with an ``arrival`` struct that orders duplicates (first wins)."""
    ch = children(pages)
    fetched = F.col("fetched_at") if "fetched_at" in ch.columns else F.current_timestamp()
    arrival = F.struct(*[F.col(c) for c in arrival_cols if c in ch.columns], F.col("position"))
    return ch.select(*project(F.col("raw"), fetched), arrival.alias("arrival"),
                     *([F.col("listing")] if "listing" in ch.columns else []))


def listing_pages(posts: DataFrame, variants: list, page_size: int = 100) -> DataFrame:
    """Render posts as landed listing pages, several listings in one pass.

    ``variants`` are (listing suffix, score bump, fetch time, condition or None): each post
    appears in every listing whose condition it meets, under ``subreddit + suffix``. A page
    holds at most ``page_size`` children (page = id // page_size, the id read in base 36) plus one
    non-post child. One scan, one shuffle for all listings.
    """
    opts = F.array(*[F.struct(F.lit(sfx).alias("suffix"), F.lit(bump).cast("bigint").alias("bump"),
                              F.lit(ts).alias("fetched"),
                              (cond if cond is not None else F.lit(True)).alias("keep"))
                     for sfx, bump, ts, cond in variants])
    rows = posts.select("*", F.explode(opts).alias("_v")).where(F.col("_v.keep")).select(
        F.concat(F.col("subreddit"), F.col("_v.suffix")).alias("listing"),
        F.to_timestamp(F.col("_v.fetched")).alias("fetched_at"), "post_id",
        F.struct(
            F.lit("t3").alias("kind"),
            F.struct(
                F.col("post_id").alias("id"), F.col("subreddit"), F.col("title"), F.col("author"),
                (F.col("score") + F.col("_v.bump")).alias("score"), F.col("upvote_ratio"), F.col("num_comments"),
                (F.unix_micros(F.col("created_utc").cast("timestamp")).cast("double") / 1e6).alias("created_utc"),
                F.col("url"),
                F.concat(F.lit("/r/"), F.col("subreddit"), F.lit("/comments/"), F.col("post_id")).alias("permalink"),
                F.col("selftext"), F.col("is_self"), F.col("over_18"),
                F.col("flair").alias("link_flair_text"), F.col("domain"),
            ).alias("data")).alias("child"))
    paged = rows.withColumn("page", F.floor(F.conv("post_id", 36, 10).cast("decimal(20,0)") / page_size).cast("bigint"))
    pages = paged.groupBy("listing", "fetched_at", "page").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("post_id").alias("k"), "child"))),
                    lambda r: r["child"]).alias("kids"))
    other = F.struct(F.lit("t1").alias("kind"),
                     F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in S.POST_DATA.fields]).alias("data"))
    return pages.select(
        "listing", "page", "fetched_at",
        F.struct(F.lit(None).cast("string").alias("after"),
                 F.concat(F.col("kids"), F.array(other)).alias("children")).alias("data"))
