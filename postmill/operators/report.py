"""Table summaries and status counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import text as TX


def status_counts(posts: DataFrame) -> DataFrame:
    """total / embedded / clustered in one pass."""
    return posts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).alias("embedded"),
        F.count_if(F.col("cluster_id").isNotNull()).alias("clustered"))


def by_source(posts: DataFrame, n: int = 10) -> DataFrame:
    """Posts per source, top ``n`` by count (ties by name)."""
    return (posts.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_posts"))
            .orderBy(F.desc("n_posts"), "subreddit").limit(n))


def averages(posts: DataFrame) -> DataFrame:
    """Row count and mean score / comments (0 when there are no rows)."""
    return posts.agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 6).alias("avg_score"),
        F.round(F.coalesce(F.avg("num_comments"), F.lit(0.0)), 6).alias("avg_comments"))


def top_by_score(posts: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` posts by score (ties by id) with the cut summary title."""
    return (posts.select("post_id", "subreddit", "score", TX.cut_title("title").alias("short_title"))
            .orderBy(F.desc("score"), "post_id").limit(n))


def cluster_sizes(posts: DataFrame, keywords: DataFrame | None = None) -> DataFrame:
    """Posts per cluster with the cluster's keywords, largest first."""
    sizes = posts.where(F.col("cluster_id").isNotNull()).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n_posts"))
    if keywords is not None:
        sizes = sizes.join(keywords, "cluster_id", "left")
    return sizes.orderBy(F.desc("n_posts"), "cluster_id")


def run_sql(spark, views: dict, sql: str) -> DataFrame:
    """Ad hoc SQL over named stage tables (read statements; returns a DataFrame)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
