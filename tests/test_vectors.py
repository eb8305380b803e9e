"""Vector operators against literal cases and brute-force numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.functions import vectors as V
from postmill.operators import centres as CE
from postmill.operators import search as SE
from postmill.operators import vectors as VO


def frame(spark, rows):
    return spark.createDataFrame([(str(i), c, v) for i, (c, v) in enumerate(rows)],
                                 "post_id string, cluster_id int, vec array<double>")


def test_l2_normalize_zero_stays_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    got = [r["u"] for r in df.select(V.l2_normalize("v").alias("u")).collect()]
    assert got[0] == [0.0, 0.0] and got[1] == pytest.approx([0.6, 0.8])


def test_cosine_silhouette_four_points(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (0, [0.9, 0.1]), (1, [0.0, 0.0]), (1, [0.0, 1.0])])
    got = VO.silhouette_cosine(df).first()["silhouette_cosine"]
    assert got == pytest.approx(0.483049, abs=1e-6)


def test_cosine_silhouette_single_label(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (0, [0.0, 1.0])])
    assert VO.silhouette_cosine(df).first()["silhouette_cosine"] == -1.0


@pytest.mark.parametrize("score", [VO.silhouette_cosine, VO.silhouette_squared, VO.silhouette_euclidean])
def test_silhouette_of_equal_vectors_and_of_one_cluster(spark, score):
    same = frame(spark, [(0, [1.0, 0.0])] * 2 + [(1, [1.0, 0.0])] * 2)
    assert tuple(score(same).first()) == (pytest.approx(0.0), 4)
    assert tuple(score(frame(spark, [(0, [1.0, 0.0]), (0, [0.0, 1.0])])).first()) == (-1.0, 2)
    assert tuple(score(frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])])).first()) == (0.0, 2)


def test_intra_similarity_singletons_is_zero(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])])
    assert VO.intra_similarity(df).first()["avg_intra_cluster_similarity"] == 0.0


def brute_silhouette(x, lab, metric):
    n = len(x)
    if metric == "cosine":
        nx = np.linalg.norm(x, axis=1, keepdims=True)
        u = np.divide(x, nx, out=np.zeros_like(x), where=nx > 0)
        d = np.clip(1 - u @ u.T, 0, 2)
        np.fill_diagonal(d, 0)
    else:
        d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
        d = np.sqrt(d) if metric == "euclidean" else d
    s = []
    for i in range(n):
        own = lab == lab[i]
        if own.sum() <= 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "squared"])
def test_silhouettes_match_brute_force(spark, metric):
    from conftest import SF_SMALL
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = e.orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    lab = np.array([r["label"] for r in rows])
    df = e.select(F.col("vec_id").cast("string").alias("post_id"), F.col("label").alias("cluster_id"),
                  F.col("embedding").alias("vec"))
    got = getattr(VO, f"silhouette_{metric}")(df).first()[f"silhouette_{metric}"]
    assert got == pytest.approx(brute_silhouette(x, lab, metric), abs=1e-9)


def test_sampled_silhouette_scores_the_hashed_sample(spark):
    from hashlib import md5

    from conftest import SF_SMALL
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = sorted(e.collect(), key=lambda r: (md5(f"42:{r['vec_id']}".encode()).hexdigest(), str(r["vec_id"])))
    df = e.select(F.col("vec_id").cast("string").alias("post_id"), F.col("label").alias("cluster_id"), (F.col("vec_id") % 3).alias("third"),
                  F.col("embedding").alias("vec")).repartition(5)
    x, lab = np.array([r["embedding"] for r in rows], float), np.array([r["label"] for r in rows])
    got = VO.silhouette_euclidean(df, sample=120).first()
    assert got["silhouette_euclidean"] == pytest.approx(brute_silhouette(x[:120], lab[:120], "euclidean"), abs=1e-9) and got["n_points"] == 120
    # Every point against the sample: close to all pairs, and all points are scored.
    every = VO.silhouette_euclidean(df, sample=250, score_all=True).first()
    assert every["n_points"] == 500 and abs(every["silhouette_euclidean"] - brute_silhouette(x, lab, "euclidean")) < 0.02
    both = {r["labelling"]: r for r in VO.sampled_silhouettes(df, ["cluster_id", "third"], id_col="post_id").collect()}
    third = np.array([r["vec_id"] % 3 for r in rows])
    assert both["third"]["silhouette_euclidean"] == pytest.approx(brute_silhouette(x, third, "euclidean"), abs=1e-9)
    assert VO.sampled_silhouettes(df.limit(0), ["cluster_id"], id_col="post_id").first()["n_points"] == 0


def test_intra_similarity_matches_numpy(spark):
    from conftest import SF_SMALL
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = e.collect()
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    lab = np.array([r["label"] for r in rows])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = []
    for c in sorted(set(lab)):
        sub = u[lab == c]
        if len(sub) < 2:
            continue
        m = sub.mean(0)
        sims.extend(sub @ (m / (np.linalg.norm(m) + 1e-12)))
    df = e.select(F.col("label").alias("cluster_id"), F.col("embedding").alias("vec"))
    got = VO.intra_similarity(df).first()["avg_intra_cluster_similarity"]
    assert got == pytest.approx(float(np.mean(sims)), abs=1e-9)


def test_nearest_centroid_matches_numpy(spark):
    from conftest import SF_SMALL
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").cast("string").alias("post_id"), F.col("label").alias("cluster_id"), F.col("embedding").alias("vec"))
    cents = VO.collect_params(VO.centroids(e), ["centroid"])
    c = np.array([r["centroid"] for r in cents])
    ids = [r["cluster_id"] for r in cents]
    out = VO.nearest_centroid(e, cents).collect()
    for r in out:
        d = ((c - np.array(r["vec"], dtype=np.float64)) ** 2).sum(1)
        assert r["nearest"] == ids[int(np.argmin(d))]


def test_bin_histogram_rows_sum_to_one_or_zero(spark):
    docs = spark.createDataFrame([("a", ["x", "y", "x", "q"]), ("b", ["q"])], "post_id string, tokens array<string>")
    bins = spark.createDataFrame([("x", 0), ("y", 1)], "word string, bin int")
    long = VO.bin_histograms(docs, "tokens", bins)
    dense = {r["post_id"]: r["vec"] for r in VO.densify(long, "post_id", 2).collect()}
    assert dense["a"] == pytest.approx([2 / 3, 1 / 3]) and dense["b"] == [0.0, 0.0]


def test_mean_word_vector_ignores_unknown_tokens(spark):
    docs = spark.createDataFrame([("a", ["cat", "zzz", "zzz", "zzz"]), ("b", ["zzz"])], "post_id string, tokens array<string>")
    words = spark.createDataFrame([("cat", [1.0, 2.0])], "word string, vector array<double>")
    got = {r["post_id"]: (r["n_matched"], r["doc_vector"]) for r in VO.mean_word_vectors(docs, "tokens", words, dim=2).collect()}
    assert got["a"] == (1, [1.0, 2.0]) and got["b"] == (0, [0.0, 0.0])


def brute_nearest(x, c, keys, measure, own=None):
    out = []
    for i, p in enumerate(x):
        if measure == "euclidean":
            v = ((p - c) ** 2).sum(1)
        else:
            v = -(c @ p)
            if measure == "cosine":
                v = v / (np.linalg.norm(p) * np.linalg.norm(c, axis=1) + 1e-10)
        out.append(min((v[j], keys[j]) for j in range(len(c)) if own is None or keys[j] != own[i]))
    return out


@pytest.mark.parametrize("measure,with_own,held", [("euclidean", False, 120), ("euclidean", True, 900), ("cosine", True, 120), ("dot", True, 120), ("cosine", False, 10_000)])
def test_nearest_in_blocks_and_held_equals_brute_force(spark, measure, with_own, held):
    rng = np.random.default_rng(5)
    hubs = rng.normal(size=(12, 6)) * 3
    c = hubs[rng.integers(0, 12, 300)] + rng.normal(size=(300, 6)) * 0.2
    c[50:150] = c[50]  # a hot group of equal centres: ties, and a block that is split
    c[7] = 0
    keys = rng.permutation(300) - 100
    x = hubs[rng.integers(0, 12, 400)] + rng.normal(size=(400, 6)) * 0.3
    x[:130] = 0        # a third of the points without a direction
    x[130:140] = c[50]
    own = keys[rng.integers(0, 300, 400)]
    points = spark.createDataFrame([(str(i), int(own[i]), x[i].tolist(), i) for i in range(400)] + [("none", 0, None, 1), ("empty", 0, [], 1), (None, 0, [1.0] * 6, 1)],
                                   "post_id string, own bigint, vec array<double>, value int")
    centres = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(keys, c)], "cluster_id bigint, centroid array<double>")
    got = {int(r["post_id"]): (r["value"], r["nearest"]) for r in CE.nearest(
        points, centres, measure, own="own" if with_own else None, max_pivots=9, held_values=held).collect()}
    want = brute_nearest(x, c, keys, measure, own if with_own else None)
    assert len(got) == 400
    for i, (v, k) in enumerate(want):
        assert got[i][0] == pytest.approx(v, abs=1e-12)
        # Equal centres differ by rounding only in the brute force, never in their key's place.
        assert got[i][1] == k or brute_nearest(x[i:i + 1], c[keys == got[i][1]], keys[keys == got[i][1]], measure)[0][0] == pytest.approx(v, abs=1e-15)


@pytest.mark.parametrize("held", [600, 100_000])
def test_nearest_deals_tasks_by_pairs(spark, monkeypatch, held):
    """Points of one file and many centres: no task gets all pairs, in blocks as with held centres, and the answer stays."""
    rng = np.random.default_rng(8)
    x, c = rng.normal(size=(600, 6)), rng.normal(size=(200, 6))
    points = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(x)], "post_id string, vec array<double>").coalesce(1)
    centres = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "cluster_id bigint, centroid array<double>")
    for name, value in (("FEW_CENTRES", 50), ("TASK_PAIRS", 12_000), ("GROUP_PAIRS", 5_000)):
        monkeypatch.setattr(CE, name, value)
    sizes = CE._by_work(points.withColumnRenamed("post_id", "id"), 200).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) * 200 < 3 * 12_000
    got = {int(r["post_id"]): r["nearest"] for r in CE.nearest(points, centres, held_values=held).collect()}
    assert got == {i: int(((v - c) ** 2).sum(axis=1).argmin()) for i, v in enumerate(x)}


def test_nearest_without_centres_and_with_one(spark):
    points = spark.createDataFrame([("a", 1, [1.0, 2.0])], "post_id string, own int, vec array<double>")
    none = spark.createDataFrame([], "cluster_id int, centroid array<double>")
    one = spark.createDataFrame([(1, [1.0, 0.0]), (None, [9.0, 9.0])], "cluster_id int, centroid array<double>")
    assert CE.nearest(points, none).collect() == []
    assert [tuple(r) for r in CE.nearest(points, one).collect()] == [("a", 1, 4.0)]
    assert CE.nearest(points, one, own="own").collect() == []


def test_more_clusters_than_a_constant_holds_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(11)
    lab = np.r_[rng.integers(0, 12, 150), [90, 91]]  # two singletons
    x = rng.normal(size=(152, 5)) + lab[:, None] * 0.3
    x[:20] = 0
    df = frame(spark, [(int(c), v.tolist()) for c, v in zip(lab, x)])
    queries = df.select(F.col("post_id").alias("item_id"), F.col("vec").alias("query_vec"))

    def results():
        near = VO.nearest_centroid(df, VO.centroids(df)).select("post_id", "nearest", F.round("nearest_sq_dist", 9)).collect()
        found = SE.semantic_match(queries, df).select("item_id", "best_cluster", F.round("similarity", 9)).collect()
        return (VO.silhouette_cosine(df).first()[0], VO.silhouette_squared(df).first()[0]), sorted(map(tuple, near)), sorted(map(tuple, found))

    few = results()
    monkeypatch.setattr(VO, "MAX_CLUSTERS", 5)
    monkeypatch.setattr(CE.nearest, "__defaults__", (*CE.nearest.__defaults__[:-1], 30))
    many = results()
    assert many[0] == pytest.approx(few[0], abs=1e-9)
    assert many[1:] == few[1:]


def test_silhouette_scores_all_points_of_a_table_larger_than_the_sample(spark):
    from postmill import lexicon as L
    rng = np.random.default_rng(8)
    n = L.SILHOUETTE_SAMPLE + 100
    lab = rng.integers(0, 3, n)
    lab[7] = 9  # a singleton
    x = rng.normal(size=(n, 2)) + lab[:, None]
    got = VO.silhouette_euclidean(frame(spark, [(int(c), v) for c, v in zip(lab, x.tolist())])).first()
    assert got["n_points"] == n
    assert got["silhouette_euclidean"] == pytest.approx(brute_silhouette(x, lab, "euclidean"), abs=1e-9)
