"""Post enrichment: cleaned text, masked author, readable date, keywords, topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import text as TX


def enrich(posts: DataFrame, unescape: bool = True, keep=()) -> DataFrame:
    """One projection per post; no shuffle. OCR text is always '' (OCR is not run).

    Missing author / created_utc columns are treated as empty. ``keep`` columns pass through.
    """
    for c in ("author", "created_utc"):
        if c not in posts.columns:
            posts = posts.withColumn(c, F.lit(None).cast("string"))
    cleaned = posts.select(
        "post_id", *keep,
        TX.strong_clean("title", unescape).alias("cleaned_title"),
        TX.strong_clean("selftext", unescape).alias("cleaned_selftext"),
        TX.mask_author(F.coalesce(F.col("author"), F.lit(""))).alias("masked_author"),
        TX.readable_date("created_utc").alias("readable_date"),
        F.lit("").alias("ocr_text"))
    combined = TX.join_text("cleaned_title", "cleaned_selftext", "ocr_text")
    # Tokens as their own column: when both keywords and topics are selected the optimizer
    # keeps one projection for them (evaluated once); when one is unused it is pruned.
    tok = cleaned.withColumn("_tok", TX.tokens(combined))
    return tok.select(
        *cleaned.columns,
        TX.top_terms(TX.drop_words("_tok"), L.KEYWORDS_PER_POST).alias("keywords"),
        TX.top_topics("_tok").alias("topics"))


def pending(posts: DataFrame, enriched: DataFrame) -> DataFrame:
    """Posts not yet enriched: an anti-join on the key (nothing is updated in place)."""
    return posts.join(enriched.select("post_id"), "post_id", "left_anti")


def enrich_pending(posts: DataFrame, enriched: DataFrame) -> DataFrame:
    """Incremental enrichment: only the rows missing from ``enriched``."""
    return enrich(pending(posts, enriched))
