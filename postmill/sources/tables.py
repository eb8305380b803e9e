"""Reading the given parquet tables and the posts view defined over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import text as TX

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SIDE_COLUMNS = {
    "events": ("author", "score", "created_utc"),
    "pages": ("url", "is_self", "domain"),
    "labels": ("upvote_ratio", "over_18"),
}
ALL_COLUMNS = ("post_id", "subreddit", "title", "author", "score", "upvote_ratio", "num_comments",
               "created_utc", "url", "selftext", "is_self", "over_18", "flair", "domain")


def posts_view(spark: SparkSession, sf_dir: str, columns=ALL_COLUMNS, where=None) -> DataFrame:
    """The posts table over the driver tables (one row per document, keyed by ``post_id``).

    documents is the post text, events the author/score/time, pages the link, labels the
    ratio and the adult flag. A side table is joined only when one of its columns is asked
    for (an outer join on a key cannot be pruned by the optimizer). All side tables join on
    the document id, so each is shuffled once on that key and the joins share one
    partitioning; small sides are broadcast by size.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    j = d
    if any(c in columns for c in SIDE_COLUMNS["events"]):
        e = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "user_id", "value", "ts")
        j = j.join(e, "doc_id", "left")
    if any(c in columns for c in SIDE_COLUMNS["pages"]):
        p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
        j = j.join(p, "doc_id", "left")
    if any(c in columns for c in SIDE_COLUMNS["labels"]):
        lb = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
        j = j.join(lb, "doc_id", "left")
    title = F.split_part(F.col("text"), F.lit("\n"), F.lit(1))
    exprs = {
        "post_id": F.col("doc_id").cast("string"),
        "subreddit": F.col("source"),
        "title": title,
        "author": F.concat(F.lit("u"), F.col("user_id").cast("string")),
        "score": F.floor(F.col("value") * 100).cast("bigint"),
        "upvote_ratio": F.coalesce(F.col("quality"), F.lit(0)).cast("double"),
        "num_comments": (F.col("n_chars") % 50).cast("bigint"),
        "created_utc": F.col("ts"),
        "url": F.coalesce(F.col("url"), F.lit("")),
        "selftext": F.expr("substr(text, length(split_part(text, '\\n', 1)) + 2)"),
        "is_self": F.col("url").isNull(),
        "over_18": F.coalesce(F.col("toxic"), F.lit(0)) == 1,
        "flair": F.col("lang"),
        "domain": TX.url_host(F.col("url")),
    }
    out = j.select(*[exprs[c].alias(c) for c in columns])
    return out.where(where) if where is not None else out


def stored_posts(spark: SparkSession, sf_dir: str, columns=ALL_COLUMNS, where=None) -> DataFrame:
    """Posts as the store keeps them: title and body light-cleaned at ingestion.

    ``where`` filters on raw columns before the cleaning, so it still reaches the scan.
    """
    v = posts_view(spark, sf_dir, columns, where)
    for c in ("title", "selftext"):
        if c in columns:
            v = v.withColumn(c, TX.light_clean(c))
    return v


TEXT_COLUMNS = ("post_id", "title", "selftext")
ENRICH_COLUMNS = ("post_id", "title", "selftext", "author", "created_utc")


def vector_width(spark: SparkSession, sf_dir: str) -> int:
    """Length of the stored vectors (0 when there are none)."""
    first = table(spark, sf_dir, "embeddings").where("embedding is not null").select(F.size("embedding").alias("n")).first()
    return first["n"] if first else 0


def sources(names: str) -> F.Column:
    """Filter on a comma list of sources, blanks dropped; an empty list keeps all. It reaches the scan or the partitions."""
    wanted = [n.strip() for n in names.split(",") if n.strip()]
    return F.col("subreddit").isin(wanted) if wanted else F.lit(True)


def flags_as_numbers(df: DataFrame) -> DataFrame:
    """Boolean columns as 0/1, for outputs that carry numbers."""
    return df.select(*[F.col(c).cast("int").alias(c) if t == "boolean" else F.col(c) for c, t in df.dtypes])


def post_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored post embeddings with their given cluster label: (post_id, embedding, cluster_id)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("post_id"),
        F.col("embedding"),
        F.col("label").alias("cluster_id"))
