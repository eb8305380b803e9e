"""Free-text search: best-matching cluster by vector similarity or keyword overlap, then
the cluster's top posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import text as TX
from postmill.functions import vectors as V
from postmill.operators import centres as CE
from postmill.operators import topk as TK
from postmill.operators import vectors as VO
from postmill.session import checkpoint_dir


def semantic_match(queries: DataFrame, members: DataFrame, key: str = "cluster_id",
                   qvec: str = "query_vec", vec: str = "vec", qid: str = "item_id") -> DataFrame:
    """Per query: the cluster whose mean vector is most cosine-similar.

    Centroids are one aggregate over the members; they travel as a constant, so queries are scored without a join.
    Too many for a constant, they meet the queries in blocks (``centres.nearest``; ids in ``qid`` are unique then).
    Ties go to the lower cluster id; with no clusters the answer is cluster 0 at -1.
    """
    checkpoint_dir(members.sparkSession)
    table = VO.centroids(members.where(F.size(vec) > 0), key, vec).checkpoint(eager=True)
    cents = VO.few_params(table, ["centroid"], key)
    if cents is None:
        best = CE.nearest(queries, table, "cosine", qid, qvec, key).select(
            qid, F.col("nearest").cast("int").alias("best_cluster"), (-F.col("value")).alias("similarity"))
        return queries.join(best, qid, "left").fillna({"best_cluster": 0, "similarity": -1.0})
    if not cents:
        return queries.withColumn("best_cluster", F.lit(0)).withColumn("similarity", F.lit(-1.0))
    c = V.const([{"id": int(r[key]), "v": [float(x) for x in r["centroid"]]} for r in cents],
                "array<struct<id:int,v:array<double>>>")
    q = V.as_double(qvec)
    scored = F.transform(c, lambda z: F.struct((-V.cosine(q, z["v"], L.COSINE_EPS)).alias("neg"), z["id"].alias("id")))
    best = F.array_min(scored)
    take = (-best["neg"]) > F.lit(-1.0)
    return queries.withColumn("best_cluster", F.when(take, best["id"]).otherwise(F.lit(0))) \
        .withColumn("similarity", F.when(take, -best["neg"]).otherwise(F.lit(-1.0)))


def keyword_match(queries: DataFrame, cluster_kw: DataFrame, key: str = "cluster_id",
                  qid: str = "query_id", qtext: str = "query_text",
                  kw_col: str = "cluster_keywords") -> DataFrame:
    """Per query: the cluster sharing most distinct non-stop-word tokens with its keywords.

    An equi-join on the word (no pairing of every query with every cluster); no overlap
    anywhere -> cluster 0 with overlap 0; ties -> lower cluster id.
    """
    qt = queries.select(qid, F.explode(F.array_distinct(TX.drop_words(TX.tokens(qtext)))).alias("word"))
    kw = cluster_kw.select(key, F.explode(F.array_distinct(F.transform(kw_col, lambda w: F.lower(w)))).alias("word"))
    over = qt.join(kw, "word").groupBy(qid, key).agg(F.count(F.lit(1)).alias("overlap"))
    best = over.groupBy(qid).agg(F.max_by(F.struct("overlap", (-F.col(key)).alias("nk")),
                                          F.struct("overlap", (-F.col(key)).alias("nk"))).alias("b"))
    best = best.select(qid, (-F.col("b.nk")).alias("best_cluster"), F.col("b.overlap").alias("overlap"))
    return queries.join(best, qid, "left").select(
        *queries.columns, F.coalesce("best_cluster", F.lit(0)).alias("best_cluster"),
        F.coalesce("overlap", F.lit(0)).cast("bigint").alias("overlap"))


def top_posts_per_cluster(posts: DataFrame, n: int = L.SEARCH_SHOWN_POSTS, key: str = "cluster_id",
                          chars: int = L.SEARCH_TITLE_CHARS) -> DataFrame:
    """Each cluster's ``n`` best posts by score (ties: post order) and the cluster size."""
    p = posts.where(F.col(key).isNotNull())
    src = p.select(key, "post_id", "score", "subreddit",
                   TX.prefix(TX.title_or_placeholder("cleaned_title"), chars).alias("title"),
                   F.col("post_id").alias("_ord"))
    top = TK.top_k_per_group(src, key, [F.desc("score"), F.col("_ord")], n).drop("_ord")
    sizes = p.groupBy(key).agg(F.count(F.lit(1)).alias("cluster_size"))
    return top.join(sizes, key)


def search_posts(matches: DataFrame, per_cluster: DataFrame, n: int = L.SEARCH_SHOWN_POSTS,
                 key: str = "cluster_id") -> DataFrame:
    """Join each query's best cluster to that cluster's shown posts (a table of at most
    ``n`` rows per cluster), with the count of posts not shown."""
    pc = per_cluster.withColumnRenamed(key, "best_cluster")
    return matches.join(pc, "best_cluster").withColumn(
        "n_more", F.greatest(F.col("cluster_size") - F.lit(n), F.lit(0)))
