"""The clustering job: vectors -> (automatic) K -> KMeans -> cluster keywords -> write-back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import text as TX
from postmill.operators import cluster as CL
from postmill.operators import profile as PF
from postmill.sources import store as ST


def run(posts: DataFrame, k: int = 0, restarts: int = L.KMEANS_RESTARTS, k_range=L.AUTO_K_RANGE,
        vec: str = "vec"):
    """``posts`` has post_id, cleaned_title, cleaned_selftext and ``vec``.

    Returns (clustered (post_id, cluster_id, cluster_keywords), chosen k, auto-K table rows).
    """
    members = posts.drop("cluster_id", "cluster_keywords").where(F.col(vec).isNotNull() & (F.size(vec) > 0))
    k_rows = []
    if k <= 0:
        k, k_rows, models = CL.auto_k(members.select("post_id", vec), "post_id", k_range, restarts, vec=vec)
        model = models.get(k) or CL.kmeans_restarts(members, k, restarts, vec=vec)[0]
    else:
        model, _ = CL.kmeans_restarts(members, k, restarts, vec=vec)
    labelled = CL.assign(model, members, vec)
    kw = PF.cluster_keywords(labelled)
    out = labelled.join(kw, "cluster_id", "left").select(
        "post_id", F.col("cluster_id").cast("int").alias("cluster_id"),
        TX.list_text("cluster_keywords").alias("cluster_keywords"))
    return out, k, k_rows


def write_back(posts: DataFrame, clustered: DataFrame) -> DataFrame:
    """Posts with cluster_id / cluster_keywords; posts not clustered keep their old values."""
    return ST.write_back(posts, clustered.select("post_id", "cluster_id", "cluster_keywords"))
