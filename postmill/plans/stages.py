"""The end-to-end run: ingest -> enrich -> embed -> cluster, each stage guarded, so a
failing stage is reported and the next stages still run on what exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import text as TX
from postmill.operators import encode as EC
from postmill.operators import enrich as EN
from postmill.plans import cluster_job as CJ
from postmill.session import scratch_path
from postmill.sources import store as ST
from postmill.streaming import ingest as IG

# Vectors are kept per encoder version, a partition each.
EMBEDDED_DDL = "post_id string, embedding array<float>, encoder string"
STATUS_DDL = "stage string, ok boolean, rows bigint, error string"


def run(spark: SparkSession, runs: list, k: int = L.EXPERIMENT_CLUSTERS, restarts: int = L.KMEANS_RESTARTS,
        encoder=None, version: str = EC.DEFAULT_VERSION, base: str | None = None) -> DataFrame:
    """``runs`` are listing-page DataFrames landed one after another. Returns a status row per stage
    (rows = rows that it added or wrote) and the totals 'posts', 'embedded' and 'clustered' of this run. All numbers are
    observed while the rows are written.

    All tables exist, empty, before the first stage, so a stage reads what there is and a failed read
    is an error, not a first run. Only posts without a vector of this encoder ``version`` are embedded, and only
    such vectors are clustered; those of another version stay until their partition is dropped. With ``base``, the folder of an
    earlier run, its tables are carried on; else they are new.
    """
    base = base or scratch_path(spark, "stages")
    landing, store, ckpt = f"{base}/landing", f"{base}/posts", f"{base}/ingest-ckpt"
    enriched_p, embedded_p, clustered_p = f"{base}/enriched", f"{base}/embedded", f"{base}/clustered"
    status = []

    def stage(name, fn):
        try:
            status.append((name, True, int(fn()), None))
        except Exception as e:  # noqa: BLE001 - a failing stage must not stop the others
            status.append((name, False, None, f"{type(e).__name__}: {str(e)[:300]}"))

    totals = {"posts": 0, "embedded": 0, "clustered": 0}

    def written(df, mode, path, counted=F.lit(True), total=None, by=()):
        """Write and return the rows written, counted on the way (nothing is read again)."""
        seen = Observation()
        df.observe(seen, F.coalesce(F.sum(F.when(counted, 1)), F.lit(0)).alias("rows")).write.mode(mode).partitionBy(*by).parquet(path)
        if total:
            totals[total] += seen.get["rows"]
        return seen.get["rows"]

    IG.init_store(spark, store)
    EN.enrich(ST.read_posts(spark, store)).withColumn("keywords", TX.list_text("keywords")).withColumn(
        "topics", TX.list_text("topics")).limit(0).write.mode("ignore").parquet(enriched_p)
    spark.createDataFrame([], EMBEDDED_DDL).write.mode("ignore").partitionBy("encoder").parquet(embedded_p)

    def vectors():
        return spark.read.schema(EMBEDDED_DDL).parquet(embedded_p)

    def ingest():
        added = 0
        for pages in runs:
            IG.land(pages, landing)
            added += IG.run_once(spark, landing, store, ckpt)["added"]
        return added

    def enrich():
        posts = ST.read_posts(spark, store)
        todo = EN.pending(posts, spark.read.parquet(enriched_p))
        out = EN.enrich(todo).withColumn("keywords", TX.list_text("keywords")).withColumn("topics", TX.list_text("topics"))
        return written(out, "append", enriched_p)

    def embed():
        e = EC.stale(spark.read.parquet(enriched_p), vectors(), version)
        text = TX.join_text("cleaned_title", "cleaned_selftext", "ocr_text")
        out = EC.encode(e.select("post_id", text.alias("text")), "text", encoder).select(
            "post_id", "embedding", F.lit(version).alias("encoder"))
        return written(out, "append", embedded_p, F.size("embedding") > 0, "embedded", ["encoder"])

    def cluster():
        e = spark.read.parquet(enriched_p).join(
            vectors().where(F.col("encoder") == version).select("post_id", F.col("embedding").alias("vec")), "post_id")
        out, _, _ = CJ.run(e, k, restarts)
        posts = ST.read_posts(spark, store).select(
            "post_id", F.lit(None).cast("int").alias("cluster_id"), F.lit("").alias("cluster_keywords"))
        return written(CJ.write_back(posts, out), "overwrite", clustered_p, F.col("cluster_id").isNotNull(), "clustered")

    for name, fn in (("ingest", ingest), ("enrich", enrich), ("embed", embed), ("cluster", cluster)):
        stage(name, fn)

    totals["posts"] = next(r[2] or 0 for r in status if r[0] == "ingest")
    status += [(name, True, n, None) for name, n in totals.items()]
    return spark.createDataFrame(status, STATUS_DDL)
