"""MLlib steps: invariants (labels, costs, repeatability, variance ratios)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.operators import cluster as CL
from postmill.operators import lloyd as LL
from postmill.operators import vectors as VO


def vectors(spark):
    from conftest import SF_SMALL
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").cast("string").alias("post_id"), F.col("embedding").alias("vec"))


def plain_lloyd(x, centres, tol=LL.TOL, max_iter=LL.MAX_ITER):
    """Textbook Lloyd iterations from given centres: (centres, cost)."""
    limit = tol * x.var(axis=0, ddof=1).mean()
    for _ in range(max_iter):
        at = ((x[:, None] - centres) ** 2).sum(-1).argmin(1)
        new = np.array([x[at == j].mean(0) if (at == j).any() else c for j, c in enumerate(centres)])
        moved, centres = ((new - centres) ** 2).sum(), new
        if moved <= limit:
            break
    return centres, ((x[:, None] - centres) ** 2).sum(-1).min(1).sum()


def test_every_restart_and_k_equals_a_plain_fit(spark):
    df = vectors(spark)
    x = np.array(sorted(r["vec"] for r in df.select(F.col("vec").cast("array<double>").alias("vec")).collect()))
    points = df.select(F.lit("a").alias("set"), "vec").unionByName(df.limit(60).select(F.lit("b").alias("set"), F.slice("vec", 1, 3).alias("vec")))
    models = LL.fit(points.repartition(7), [("a", k, 42 + r) for k in (2, 5) for r in range(3)] + [("b", 4, 1)])
    for m in models[:-1]:
        centres, cost = plain_lloyd(x, LL._seeded_start(x, m.k, m.seed))
        assert m.cost == pytest.approx(cost, rel=1e-6) and np.allclose(m.centres, centres, atol=1e-4)
    assert models[-1].centres.shape == (4, 3)
    assert LL.best(models[:3]).cost == min(m.cost for m in models[:3])


def test_one_pass_over_the_points_per_iteration(spark, monkeypatch):
    """All models share each scan: as many passes as the slowest model has iterations, and one for the costs."""
    passes = []
    step = LL._step
    monkeypatch.setattr(LL, "_step", lambda *a: passes.append(len(a[1])) or step(*a))
    models = LL.fit(vectors(spark).select(F.lit("").alias("set"), "vec"), [("", k, r) for k in (2, 3, 7) for r in range(4)])
    assert len(passes) == max(m.iterations for m in models) + 1
    assert passes[0] == 12 and passes[-2] < 12


def test_restarts_keep_lowest_cost_and_repeat(spark):
    v = vectors(spark)
    m1, costs = CL.kmeans_restarts(v, 4, restarts=3)
    m2, _ = CL.kmeans_restarts(v, 4, restarts=3)
    assert m1.cost == min(c["training_cost"] for c in costs)
    labels = CL.assign(m1, v).select("cluster_id").distinct().collect()
    assert {r["cluster_id"] for r in labels} <= set(range(4))
    a = CL.assign(m1, v).orderBy("post_id").select("cluster_id").collect()
    b = CL.assign(m2, v).orderBy("post_id").select("cluster_id").collect()
    assert a == b


def test_fewer_distinct_points_than_centres_and_no_points(spark):
    same = spark.createDataFrame([("s", [1.0, 2.0])] * 5 + [("s", [0.0, 2.0])], "set string, vec array<double>")
    m, = LL.fit(same, [("s", 4, 42)])
    assert len(m.centres) == 2 and m.cost == pytest.approx(0)
    with pytest.raises(ValueError, match="no points"):
        LL.fit(same, [("t", 2, 42)])


def test_auto_k_range_and_choice(spark):
    v = vectors(spark)
    best, rows, models = CL.auto_k(v, "post_id", k_range=(2, 4), restarts=2)
    assert [r["k"] for r in rows] == [2, 3, 4]
    top = max(r["silhouette"] for r in rows)
    assert best == min(r["k"] for r in rows if r["silhouette"] == top)
    for r in rows:
        labelled = CL.assign(models[r["k"]], v)
        assert VO.silhouette_euclidean(labelled).first()["silhouette_euclidean"] == pytest.approx(r["silhouette"], abs=1e-9)
    assert CL.auto_k(v.limit(2), "post_id") == (2, [], {})


def test_cluster_job_chooses_k(spark):
    from postmill.plans import cluster_job
    far = [(f"p{i}", "t", f"alpha{'xyz'[i % 3]} common", [float(i % 3 * 10), float(i % 7) / 10]) for i in range(60)]
    posts = spark.createDataFrame(far, "post_id string, cleaned_title string, cleaned_selftext string, vec array<double>")
    out, k, rows = cluster_job.run(posts, 0, restarts=3)
    assert k == 3 and [r["k"] for r in rows] == list(range(2, 11))
    groups = {}
    for r in out.collect():
        groups.setdefault(r["cluster_id"], set()).add(int(r["post_id"][1:]) % 3)
    assert sorted(len(g) for g in groups.values()) == [1, 1, 1]


def test_pca_ratios(spark):
    coords, ratio = CL.pca_2d(vectors(spark).withColumn("cluster_id", F.lit(0)))
    assert 0 < ratio[1] <= ratio[0] <= 1 and coords.count() == 500
    means = coords.agg(F.avg("pc1").alias("a"), F.avg("pc2").alias("b")).first()
    assert abs(means["a"]) < 1e-9 and abs(means["b"]) < 1e-9


def test_points_are_in_their_nearest_cluster(spark):
    from postmill.plans import catalog
    got = catalog.QUERIES["kmeans_restarts"](spark, "/root/testdata/sf0.001")
    assert got.count() == 500 and got.where("in_nearest").count() == 500


def test_word_numbers_are_dense_and_fixed(spark):
    from postmill.operators import docvec as DV
    words = spark.createDataFrame([(f"w{i % 37}",) for i in range(200)], "word string").distinct()
    n = sorted((r["ix"], r["word"]) for r in DV.with_index(words, "ix").collect())
    assert [i for i, _ in n] == list(range(37)) and [w for _, w in n] == sorted(w for _, w in n)


def test_document_and_word_vectors(spark):
    from postmill.operators import docvec as DV
    docs = spark.createDataFrame([(str(i), ["cat", "dog", "sun"] if i % 2 else ["tax", "law", "vote"]) for i in range(12)],
                                 "post_id string, tokens array<string>")
    vecs = DV.doc_vectors_als(docs, {"vector_size": 4, "sweeps": 3, "min_count": 2})
    assert vecs.count() == 12 and {len(r["vec"]) for r in vecs.collect()} == {4}
    dense, bins = DV.word2vec_bins(docs, {"vector_size": 4, "window": 2, "min_count": 2, "epochs": 2, "bins": 3}, restarts=2)
    assert bins == 3 and all(abs(sum(r["vec"]) - 1) < 1e-9 for r in dense.collect())


def test_ratings_are_the_ppmi_weights_as_lists(spark, monkeypatch):
    """Equal to ``wordvec.ppmi`` with one and several blocks of words, a key in two rows, a null key and a text without words."""
    from postmill.operators import docvec as DV
    from postmill.operators import wordtable as WT
    from postmill.operators import wordvec as WV
    rng = np.random.default_rng(2)
    rows = [(f"d{i % 35}", [f"w{w}" for w in rng.zipf(1.5, 30) % 60]) for i in range(40)] + [("none", []), (None, ["w1", "w2"]), ("once", ["seldom"])]
    docs = spark.createDataFrame(rows, "post_id string, tokens array<string>")
    words = {w: i for i, w in enumerate(sorted(r["word"] for r in WV.vocabulary(docs).collect()))}
    want = {(r["post_id"], words[r["word"]]): r["ppmi"] for r in WV.ppmi(docs).collect()}
    for size in (WT.BLOCK_BYTES, 1000):
        monkeypatch.setattr(WT, "BLOCK_BYTES", size)
        lists, doc_ix = DV.doc_word_ratings(docs)
        assert lists.count() == 40 and doc_ix.count() == 43  # one row a document: none per word is stored
        got = {(r["post_id"], w): x for r in lists.join(doc_ix, "doc_ix").collect() for w, x in zip(r["words"], r["ppmi"], strict=True)}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)


def test_bins_of_several_word_tables_are_one_fit(spark):
    from postmill.operators import docvec as DV
    rng = np.random.default_rng(1)
    tables = {n: spark.createDataFrame([(f"w{i}", [float(v) for v in rng.normal(size=d)]) for i in range(20)], "word string, vec array<double>")
              for n, d in (("x", 3), ("y", 5))}
    found, bins = DV.word_bins(tables, {"x": {"bins": 4}, "y": {"bins": 50}}, restarts=2)
    assert bins == {"x": 4, "y": 20}
    by = {(r["name"], r["n"], r["words"]) for r in found.groupBy("name").agg(F.countDistinct("bin").alias("n"), F.count("*").alias("words")).collect()}
    assert by == {("x", 4, 20), ("y", 20, 20)}


@pytest.mark.parametrize("paragraph", [False, True])
def test_experiment_of_two_small_configurations(spark, tmp_path, paragraph):
    from postmill.operators import evaluate as EV
    from postmill.plans import experiment
    rows = [(f"p{i:03}", f"title {i}", " ".join(t), t) for i in range(40)
            for t in [["cat", "dog", "sun", f"zoo{'ab'[i % 2]}"] * 3 if i % 2 else ["tax", "law", "vote", "poll"] * 3]]
    train = spark.createDataFrame(rows, "post_id string, title string, text string, tokens array<string>")
    found = experiment.run(spark, train, 2, 2, [{"name": "doc2vec_4d", "vector_size": 4, "epochs": 20, "window": 3, "min_count": 2, "sweeps": 3, "rate": 0.1}],
                           [{"name": "w2v_bins_4d", "vector_size": 4, "epochs": 5, "min_count": 2, "window": 2, "bins": 4}], str(tmp_path / "out"), paragraph)
    assert [r["method"] for r in found] == ["doc2vec_4d", "w2v_bins_4d"] and found[1]["word_bins"] == 4 and found[0]["word_bins"] is None
    for r in found:
        assert r["n_posts"] == 40 and r["vector_dimension"] == 4 and sum(d["size"] for d in r["cluster_details"]) == 40
        assert all(1 <= len(d["top_words"]) <= 8 and len(d["sample_titles"]) == 4 for d in r["cluster_details"])
    if paragraph:  # 480 tokens train paragraph vectors too little to part the topics (README.md); their rows are checked above
        return
    pets = [d for d in found[0]["cluster_details"] if "cat" in d["top_words"]]
    assert len(pets) == 1 and pets[0]["top_words"][:3] == ["cat", "dog", "sun"] and pets[0]["sample_titles"][0] == "title 1"
    assert EV.comparison(EV.results_frame(spark, found)).count() == 2
    assert spark.read.json(str(tmp_path / "out" / "methods")).count() == 2


def test_experiment_needs_posts(spark):
    import pytest
    from postmill.plans import experiment
    empty = spark.createDataFrame([], "post_id string, title string, text string, tokens array<string>")
    with pytest.raises(ValueError, match="no usable posts"):
        experiment.run(spark, empty)


def test_a_failing_stage_does_not_stop_the_others(spark):
    from postmill.plans import catalog, stages
    runs = catalog._runs(spark, "/root/testdata/sf0.001")

    def broken():
        raise RuntimeError("no encoder")

    got = {r["stage"]: (r["ok"], r["rows"]) for r in stages.run(spark, list(runs), restarts=1, encoder=broken).collect()}
    assert got["ingest"] == (True, 200) and got["enrich"] == (True, 200) and got["posts"] == (True, 200)
    assert got["embed"][0] is False and got["embedded"] == (True, 0)


def test_another_encoder_version_embeds_again(spark):
    from postmill.plans import catalog, stages
    from postmill.session import scratch_path
    runs, base = list(catalog._runs(spark, "/root/testdata/sf0.001")), scratch_path(spark, "versions")

    def embedded(runs, version):
        got = {r["stage"]: (r["ok"], r["rows"]) for r in stages.run(
            spark, runs, k=3, restarts=1, encoder=catalog.counting_encoder, version=version, base=base).collect()}
        assert all(ok for ok, _ in got.values()) and got["clustered"][1] == 200
        return got["embedded"][1]

    assert [embedded(runs, "a-1"), embedded([], "a-1"), embedded([], "a-2")] == [200, 0, 200]
    kept = spark.read.parquet(f"{base}/embedded").groupBy("encoder").count().collect()
    assert sorted(map(tuple, kept)) == [("a-1", 200), ("a-2", 200)]


def test_pca_against_power_iteration(spark):
    from postmill.operators import cluster as CL
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 6)) * [5, 3, 1, 1, .5, .2] + 4
    df = spark.createDataFrame([(str(i), i % 3, v.tolist()) for i, v in enumerate(x)], "post_id string, cluster_id int, vec array<double>")
    coords, ratio = CL.pca_2d(df)
    got = np.array([(r["pc1"], r["pc2"]) for r in sorted(coords.collect(), key=lambda r: int(r["post_id"]))])
    centred = x - x.mean(axis=0)
    left, total = centred.T @ centred, (centred ** 2).sum()
    for k in range(2):
        v = np.ones(6)
        for _ in range(2000):
            v = left @ v
            v /= np.linalg.norm(v)
        share = v @ left @ v
        assert ratio[k] == pytest.approx(share / total, rel=1e-6)
        assert np.abs(got[:, k]) == pytest.approx(np.abs(centred @ v), abs=1e-5)
        left = left - share * np.outer(v, v)


def test_models_share_matrix_products_of_a_bounded_number_of_centres():
    models = [(m, np.full((k, 2), float(m))) for m, k in enumerate((3, 400, 700, 5, 2000, 2))]
    stacks = LL._stacks(models, np.float32)
    assert [[m for m, _ in group] for group, _, _ in stacks] == [[0, 1], [2, 3], [4], [5]]
    assert all(len(c) == sum(k for _, k in group) == len(norms) and c.dtype == np.float32 for group, c, norms in stacks)
