"""Keyword extraction: per post (inside the row) and per group (distributed top-k)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import text as TX


def post_keywords(df: DataFrame, text_col: str = "text", n: int = L.KEYWORDS_PER_POST,
                  out: str = "keywords", stop_words=L.STOP_WORDS) -> DataFrame:
    """Top-``n`` non-stop-word tokens per row, count desc then first occurrence.

    Map-only: the ranking happens inside each row, so there is no shuffle and no skew,
    however long a text or however hot a source.
    """
    return df.withColumn(out, TX.top_terms(TX.drop_words(TX.tokens(text_col), stop_words), n))


def group_token_counts(df: DataFrame, group_col: str, text_col: str, order_col: str,
                       stop_words=L.STOP_WORDS) -> DataFrame:
    """(group, tok, n, first) with ``first`` = earliest (row order, position) of ``tok``.

    Tokens are filtered inside the array before the explode; the aggregate combines
    map-side first, so a group holding a third of all rows still spreads over its tokens.
    """
    exploded = df.select(
        F.col(group_col), F.col(order_col).alias("_ord"),
        F.posexplode(TX.drop_words(TX.tokens(text_col), stop_words)).alias("_pos", "tok"))
    return exploded.groupBy(group_col, "tok").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("_ord", "_pos")).alias("first"))


def group_keywords(df: DataFrame, group_col: str, text_col: str, order_col: str,
                   n: int = L.KEYWORDS_PER_CLUSTER, stop_words=L.STOP_WORDS,
                   out: str = "keywords") -> DataFrame:
    """Top-``n`` tokens over all texts of each group (texts taken in ``order_col`` order).

    ``row_number() <= n`` becomes a WindowGroupLimit, which Spark applies before the
    shuffle as well, so each map task sends at most ``n`` rows per group.
    """
    counts = group_token_counts(df, group_col, text_col, order_col, stop_words)
    w = Window.partitionBy(group_col).orderBy(F.desc("n"), F.asc("first"))
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return top.groupBy(group_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "tok"))), lambda r: r["tok"]).alias(out))


def group_keyword_counts(df: DataFrame, group_col: str, text_col: str, order_col: str,
                         n: int, stop_words=L.STOP_WORDS) -> DataFrame:
    """Like ``group_keywords`` but long form: (group, rank, word, count)."""
    counts = group_token_counts(df, group_col, text_col, order_col, stop_words)
    w = Window.partitionBy(group_col).orderBy(F.desc("n"), F.asc("first"))
    return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select(group_col, "rank", F.col("tok").alias("word"), F.col("n").alias("count")))
