"""Plan shape: the properties that matter at scale, checked on the physical plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry


def plan(spark, name, sf="/root/testdata/sf0.001"):
    df = entry.queries()[name](spark, sf)
    return df._jdf.queryExecution().executedPlan().toString()


def test_per_post_keywords_do_not_shuffle_tokens(spark):
    p = plan(spark, "keywords_per_post")
    assert "Exchange hashpartitioning" not in p and "Generate" not in p


def test_cluster_keywords_limit_before_shuffle(spark):
    p = plan(spark, "cluster_keywords")
    assert "WindowGroupLimit" in p


def test_raw_filters_reach_the_scan(spark):
    p = plan(spark, "pending_posts")
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p or "EqualTo(lang,en)" in p


def test_text_only_queries_skip_side_tables(spark):
    p = plan(spark, "strong_clean")
    assert "events.parquet" not in p and "pages.parquet" not in p and "labels.parquet" not in p


def test_building_a_top_k_plan_runs_no_job(spark):
    from postmill.operators.topk import top_k_per_group

    agg = spark.range(1000).groupBy((F.col("id") % 7).alias("g"), (F.col("id") % 50).alias("v")).count()
    sc = spark.sparkContext
    sc.setJobGroup("topk-plan", "plan only")
    top = top_k_per_group(agg, "g", [F.desc("count"), "v"], 3)
    assert not sc.statusTracker().getJobIdsForGroup("topk-plan")
    assert top.count() == 21
    sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["search_keyword", "nearest_centroid", "silhouette_cosine", "title_histogram",
                                  "ppmi_weights", "dedup_append"])
def test_no_cartesian_products(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
