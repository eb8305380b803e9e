"""Group keywords, search and evaluation helpers against brute force."""

import pytest
from pyspark.sql import functions as F

from postmill.operators import evaluate as EV
from postmill.operators import keywords as KW
from postmill.operators import profile as PF
from postmill.operators import report as RP
from postmill.operators import search as SE


def test_group_keywords_take_texts_in_order(spark):
    rows = [("1b", "g", "zebra apple"), ("1a", "g", "melon apple zebra"), ("2", "g", "kiwi the and"), ("3", "h", "kiwi, kiwi; melon")]
    d = spark.createDataFrame(rows, "post_id string, source string, text string")
    got = {r["source"]: r["keywords"] for r in KW.group_keywords(d, "source", "text", "post_id", 3).collect()}
    assert got == {"g": ["apple", "zebra", "melon"], "h": ["kiwi", "melon"]}


def test_text_ids_of_any_form(spark):
    """Base-36 ids in top posts, keywords, samples, title histogram, search and the report."""
    rows = [("1abc2d", 1, 5, "alpha beta", "s"), ("zz9", 1, 5, "beta alpha", "s"), ("1abc2c", 1, 5, "gamma", "t")]
    p = spark.createDataFrame(rows, "post_id string, cluster_id int, score int, cleaned_title string, subreddit string") \
        .withColumn("cleaned_selftext", F.lit("")).withColumn("title", F.col("cleaned_title")).withColumn("text", F.col("cleaned_title"))
    assert [r["post_id"] for r in RP.top_by_score(p).collect()] == ["1abc2c", "1abc2d", "zz9"]
    assert PF.cluster_keywords(p).first()["cluster_keywords"] == ["alpha", "beta", "gamma"]
    assert [r["post_id"] for r in PF.cluster_samples(p).orderBy("rank").collect()] == ["1abc2c", "1abc2d", "zz9"]
    assert [(r["word"], r["count"]) for r in PF.title_histogram(p).orderBy("rank").collect()] == [("alpha", 2), ("beta", 2), ("gamma", 1)]
    assert [r["post_id"] for r in SE.top_posts_per_cluster(p).orderBy("rank").collect()] == ["1abc2c", "1abc2d", "zz9"]
    assert EV.cluster_descriptions(p).first()["sample_titles"] == ["gamma", "alpha beta", "beta alpha"]


def test_report_slice_and_comparison(spark):
    details = [{"cluster_id": i, "size": 5, "top_words": [str(w) for w in range(8)], "sample_titles": ["a", "b", "c", "d"]} for i in range(5)]
    r = EV.results_frame(spark, [result("doc2vec_50d", 0.4, 0.9, 50) | {"cluster_details": details}, result("w2v_bins_50d", 0.5, 0.1, 50)])
    cut = EV.report_slice(r).collect()
    assert len(cut) == 3 and all(len(x["top_words"]) == 6 and len(x["sample_titles"]) == 3 for x in cut)
    got = [(x["method"], x["place"], x["wins_dimension"], x["report"] and len(x["report"])) for x in EV.comparison(r).orderBy("place").collect()]
    assert got == [("w2v_bins_50d", 1, True, None), ("doc2vec_50d", 2, False, 3)]


def test_keyword_search_no_overlap_is_cluster_zero(spark):
    q = spark.createDataFrame([(1, "quantum nothing"), (2, "zebra")], "query_id int, query_text string")
    kw = spark.createDataFrame([(3, ["quantum"]), (4, ["quantum"]), (5, ["other"])], "cluster_id int, cluster_keywords array<string>")
    got = {r["query_id"]: (r["best_cluster"], r["overlap"]) for r in SE.keyword_match(q, kw).collect()}
    assert got == {1: (3, 1), 2: (0, 0)}


def test_semantic_search_picks_most_similar_and_breaks_ties_low(spark):
    members = spark.createDataFrame([(1, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [0.0, 1.0])], "cluster_id int, vec array<double>")
    q = spark.createDataFrame([(1, [0.1, 1.0]), (2, [1.0, 0.0])], "query_id int, query_vec array<double>")
    got = {r["query_id"]: r["best_cluster"] for r in SE.semantic_match(q, members).collect()}
    assert got == {1: 2, 2: 1}


def result(name, sil, intra, dim):
    return {"method": name, "n_posts": 10, "n_clusters": 5, "vector_dimension": dim, "silhouette_cosine": sil,
            "avg_intra_cluster_similarity": intra, "word_bins": None, "cluster_details": []}


def test_best_config_tie_keeps_earlier(spark):
    r = EV.results_frame(spark, [result("doc2vec_50d", 0.5, 0.5, 50), result("w2v_bins_50d", 0.5, 0.5, 50)])
    assert EV.best_config(r).first()["method"] == "doc2vec_50d"


def test_dimension_winner_first_match_and_ties(spark):
    r = EV.results_frame(spark, [result("doc2vec_50d", 0.4, 0.9, 50), result("doc2vec_x", 0.9, 0.9, 50),
                                 result("w2v_bins_50d", 0.4, 0.9, 50), result("w2v_bins_100d", 0.1, 0.1, 100)])
    got = {x["vector_dimension"]: x["winner"] for x in EV.dimension_winner(r).collect()}
    assert got == {50: "doc2vec_50d"}


def test_results_ordered(spark):
    r = EV.results_frame(spark, [result("w2v_bins_50d", 0.1, 0.1, 50), result("doc2vec_100d", 0.1, 0.1, 100),
                                 result("doc2vec_50d", 0.1, 0.1, 50)])
    assert [x["method"] for x in EV.results_ordered(r).collect()] == ["doc2vec_50d", "doc2vec_100d", "w2v_bins_50d"]


@pytest.mark.parametrize("name,family", [("doc2vec_50d", "Doc2Vec"), ("w2v_bins_50d", "Word2Vec+Bins")])
def test_method_family(spark, name, family):
    df = spark.createDataFrame([(name,)], "method string")
    assert df.select(EV.method_family("method").alias("f")).first()["f"] == family


def test_results_are_saved_one_file_per_method(spark, tmp_path):
    import json
    from postmill.plans import experiment
    experiment.save_json(spark, [result("doc2vec_50d", 0.4, 0.9, 50), result("w2v_bins_50d", 0.5, 0.1, 50)], str(tmp_path))
    for name in ("doc2vec_50d", "w2v_bins_50d"):
        files = list((tmp_path / "methods" / f"method={name}").glob("part-*.json"))
        assert len(files) == 1 and json.loads(files[0].read_text())["n_posts"] == 10
    text = next((tmp_path / "summary").glob("part-*")).read_text()
    assert json.loads(text)["best_overall"] == "w2v_bins_50d"
