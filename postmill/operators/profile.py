"""Cluster profiles: keywords, sizes, sample titles, title histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import text as TX
from postmill.operators import keywords as KW
from postmill.operators import topk as TK


def post_order(post_id="post_id"):
    """Row order of posts: the id, which is text of any form (the store has no other stable order)."""
    return F.col(post_id)


def cluster_keywords(posts: DataFrame, n: int = L.KEYWORDS_PER_CLUSTER, key: str = "cluster_id",
                     stop_words=L.STOP_WORDS) -> DataFrame:
    """Top-``n`` tokens over the cleaned texts of each cluster's members."""
    src = posts.where(F.col(key).isNotNull()).select(
        key, post_order().alias("_ord"), TX.join_text("cleaned_title", "cleaned_selftext").alias("_text"))
    return KW.group_keywords(src, key, "_text", "_ord", n, stop_words, out="cluster_keywords")


def cluster_samples(posts: DataFrame, n: int = L.SAMPLE_TITLES_PER_CLUSTER, key: str = "cluster_id",
                    chars: int = L.SAMPLE_TITLE_CHARS) -> DataFrame:
    """First ``n`` member titles per cluster in post order (skew-safe top-k per group)."""
    src = posts.where(F.col(key).isNotNull()).select(
        key, "post_id", TX.prefix(TX.title_or_placeholder("cleaned_title"), chars).alias("title"),
        post_order().alias("_ord"))
    return TK.top_k_per_group(src, key, ["_ord"], n).drop("_ord")


def title_histogram(posts: DataFrame, n: int = 10, key: str = "cluster_id") -> DataFrame:
    """Top-``n`` title words per cluster, titles taken by score desc (ties: post order)."""
    src = posts.where(F.col(key).isNotNull()).select(
        key, F.struct((-F.col("score")).alias("s"), post_order().alias("p")).alias("_ord"),
        F.coalesce("cleaned_title", F.lit("")).alias("_text"))
    return KW.group_keyword_counts(src, key, "_text", "_ord", n)
