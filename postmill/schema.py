"""Explicit schemas: the landed listing JSON and the posts store."""

from pyspark.sql import types as T

POST_DATA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("upvote_ratio", T.DoubleType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("url", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("is_self", T.BooleanType()),
    T.StructField("over_18", T.BooleanType()),
    T.StructField("link_flair_text", T.StringType()),
    T.StructField("domain", T.StringType()),
])

LISTING = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("after", T.StringType()),
        T.StructField("children", T.ArrayType(T.StructType([
            T.StructField("kind", T.StringType()),
            T.StructField("data", POST_DATA),
        ]))),
    ])),
])

# Landed listing files also carry where they came from and when they arrived.
LANDED_LISTING = T.StructType(LISTING.fields + [
    T.StructField("listing", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("fetched_at", T.TimestampType()),
])

POSTS = T.StructType([
    T.StructField("post_id", T.StringType(), False),
    T.StructField("subreddit", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("upvote_ratio", T.DoubleType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("created_utc", T.TimestampNTZType()),
    T.StructField("url", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("is_self", T.BooleanType()),
    T.StructField("over_18", T.BooleanType()),
    T.StructField("flair", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("fetched_at", T.TimestampType(), False),
])
