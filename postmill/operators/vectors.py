"""Vector aggregates and cluster geometry: centroids, nearest centroid, intra-cluster
similarity, cosine and Euclidean silhouettes, word-table document vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import vectors as V
from postmill.operators import centres as CE
from postmill.operators import lloyd as LL
from postmill.operators import wordtable as WT
from postmill.operators.lloyd import _matrix
from postmill.session import checkpoint_dir, stored

# Up to this many clusters (and ``V.MAX_CONST_VALUES`` numbers) statistics travel as model parameters; beyond, they stay a
# table (``operators/centres.py``), with the same results.
MAX_CLUSTERS = 10_000


def cluster_stats(df: DataFrame, key: str = "cluster_id", vec: str = "vec") -> DataFrame:
    """Per cluster: member count, componentwise sum and mean (one aggregate, map-side combined)."""
    s = df.groupBy(key).agg(Summarizer.metrics("mean", "count").summary(array_to_vector(V.as_double(vec))).alias("_s"))
    return s.select(key, F.col("_s.count").alias("n"), vector_to_array(F.col("_s.mean")).alias("mean")) \
        .withColumn("sum", V.scale("mean", F.col("n").cast("double")))


def centroids(df: DataFrame, key: str = "cluster_id", vec: str = "vec") -> DataFrame:
    """Componentwise mean per cluster: (key, n, centroid)."""
    return cluster_stats(df, key, vec).select(key, "n", F.col("mean").alias("centroid"))


def collect_params(stats: DataFrame, cols: list, key: str = "cluster_id") -> list:
    """Collect per-cluster parameters, once; more than MAX_CLUSTERS clusters are an error."""
    rows = stats.select(key, *cols).limit(MAX_CLUSTERS + 1).collect()
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    return sorted((r.asDict() for r in rows), key=lambda r: r[key])


def few_params(stats: DataFrame, cols: list, key: str = "cluster_id") -> list | None:
    """``collect_params``, or None where the clusters are too many to travel as one constant."""
    widths = [F.sum(F.size(c) if stats.schema[c].dataType.typeName() == "array" else F.lit(1)) for c in cols]
    n, values = stats.agg(F.count(F.lit(1)), F.coalesce(sum(widths, F.lit(0)), F.lit(0)) + F.count(F.lit(1))).first()
    return collect_params(stats, cols, key) if n <= MAX_CLUSTERS and values <= V.MAX_CONST_VALUES else None


def nearest_centroid(points: DataFrame, cents: list | DataFrame, key: str = "cluster_id", vec: str = "vec",
                     out: str = "nearest", id_col: str = "post_id") -> DataFrame:
    """Assign each point to the closest centroid (squared Euclidean; ties -> lower id).

    ``cents`` are model parameters: a list of {key, centroid}. They travel as one constant; the points are not
    shuffled. A DataFrame (key, centroid) may hold any number of centroids: too many for a constant meet the points in
    blocks (``centres.nearest``; ids in ``id_col`` are unique then).
    """
    if isinstance(cents, DataFrame):
        checkpoint_dir(points.sparkSession)
        table = cents.select(key, "centroid").checkpoint(eager=True)
        cents = few_params(table, ["centroid"], key)
        if cents is None:
            best = CE.nearest(points, table, "euclidean", id_col, vec, key)
            return points.join(best.select(id_col, F.col("nearest").cast("int").alias(out), F.col("value").alias(f"{out}_sq_dist")), id_col, "left")
    c = V.const([{"id": int(r[key]), "v": [float(x) for x in r["centroid"]]} for r in cents],
                "array<struct<id:int,v:array<double>>>")
    x = V.as_double(vec)
    best = F.array_min(F.transform(c, lambda z: F.struct(V.sq_dist(x, z["v"]).alias("d"), z["id"].alias("id"))))
    return points.withColumn(out, best["id"]).withColumn(f"{out}_sq_dist", best["d"])


def intra_similarity(df: DataFrame, key: str = "cluster_id", vec: str = "vec") -> DataFrame:
    """Average cosine of members to their normalised cluster mean, pooled over members of
    clusters with at least two members; 0.0 when there are none.

    Sum over members of x.c_hat equals S.c_hat (S = sum of normalised members), so one
    aggregate per cluster suffices: no join back to the members.
    """
    normed = df.select(key, V.l2_normalize(vec).alias("u"))
    st = cluster_stats(normed, key, "u").where(F.col("n") >= 2)
    c_hat = V.scale("mean", F.lit(1.0) / (V.norm("mean") + F.lit(L.INTRA_EPS)))
    per = st.select(key, "n", V.dot("sum", c_hat).alias("sim_sum"))
    return per.agg(F.coalesce(F.sum("sim_sum") / F.sum("n"), F.lit(0.0)).alias("avg_intra_cluster_similarity"),
                   F.coalesce(F.sum("n"), F.lit(0)).alias("n_members"))


def _silhouette(points: DataFrame, stats: list, key: str, vec: str, per_cluster, out: str) -> DataFrame:
    """Mean silhouette from each cluster's sums; ``per_cluster(x, z)`` is the sum of a point's distances to cluster z.

    a = sum to the own cluster / (n - 1), b = least mean to another; a member of a singleton scores 0, and so does a
    point at distance 0 from both. With fewer than two clusters the silhouette is -1.
    """
    if len(stats) < 2:
        return points.agg(F.lit(-1.0).alias(out), F.count(F.lit(1)).alias("n_points"))
    c = V.const([{"id": int(r[key]), "n": int(r["n"]), "q": float(r["q"]), "s": [float(x) for x in r["sum"]]} for r in stats],
                "array<struct<id:int,n:bigint,q:double,s:array<double>>>")
    own = F.col(key)
    per = points.select(own, F.transform(c, lambda z: F.struct(
        z["id"].alias("id"), z["n"].alias("n"), per_cluster(F.col(vec), z).alias("d"))).alias("t"))
    per = per.select(F.filter("t", lambda z: z["id"] == own)[0].alias("mine"),
                     F.array_min(F.transform(F.filter("t", lambda z: z["id"] != own), lambda z: z["d"] / z["n"])).alias("b"))
    a = F.col("mine.d") / F.greatest(F.col("mine.n") - 1, F.lit(1))
    top = F.greatest(a, F.col("b"))
    s = F.when((F.col("mine.n") <= 1) | (top == 0), F.lit(0.0)).otherwise((F.col("b") - a) / F.nullif(top, F.lit(0.0)))
    return per.select(s.alias("s")).agg(F.avg("s").alias(out), F.count(F.lit(1)).alias("n_points"))


def _numbered(points: DataFrame, key: str, vec: str) -> DataFrame:
    return points.select(F.monotonically_increasing_id().alias("id"), key, F.col(vec).alias("x"))


def silhouette_cosine(df: DataFrame, key: str = "cluster_id", vec: str = "vec") -> DataFrame:
    """Mean cosine silhouette of all points, closed form; -1.0 when there is a single cluster.

    Distance is 1 - u.v on L2-normalised vectors (a zero vector is at distance 1 from all others), so a
    point's distances to cluster z sum to n - u.S; its own term, 1 - u.u, is taken off.
    """
    normed = df.select(key, V.l2_normalize(vec).alias("u"))
    table = cluster_stats(normed, key, "u").withColumn("q", F.lit(0.0))
    stats = few_params(table, ["n", "sum", "q"], key)
    if stats is None:
        to_own = (F.col("n") - V.dot("x", "sum") - (1 - V.dot("x", "x"))) / F.greatest(F.col("n") - 1, F.lit(1))
        return CE.silhouette(_numbered(normed, key, "u"), table.withColumn("centroid", F.col("mean")), to_own, F.lit(1.0), "dot",
                             "silhouette_cosine", key)
    own = F.col(key)
    return _silhouette(normed, stats, key, "u",
                       lambda x, z: z["n"] - V.dot(x, z["s"]) - F.when(z["id"] == own, 1 - V.dot(x, x)).otherwise(0.0),
                       "silhouette_cosine")


def silhouette_squared(df: DataFrame, key: str = "cluster_id", vec: str = "vec") -> DataFrame:
    """Mean silhouette of all points under squared Euclidean distance, closed form; -1.0 for a single cluster.

    A point's squared distances to cluster z sum to n x.x - 2 x.S + Q, with S the sum and Q the sum of squared norms
    of its members: one aggregate and one pass over the points, no pairs and no sample.
    """
    points = df.select(key, V.as_double(vec).alias("v"))
    norms = points.groupBy(key).agg(F.sum(V.dot("v", "v")).alias("q"))
    table = cluster_stats(points, key, "v").join(norms, key)
    stats = few_params(table, ["n", "sum", "q"], key)
    if stats is None:
        # A mean squared distance is |x - mean|^2 plus the cluster's variance, which one more dimension carries.
        spread = F.sqrt(F.greatest(F.col("q") / F.col("n") - V.dot("mean", "mean"), F.lit(0.0)))
        wide = points.select(key, F.concat("v", F.array(F.lit(0.0))).alias("v"))
        to_own = F.when(F.col("n") <= 1, 0.0).otherwise(F.greatest(
            F.col("n") * V.dot("x", "x") - 2 * V.dot(F.slice("x", 1, F.size("sum")), "sum") + F.col("q"), F.lit(0.0))) / F.greatest(F.col("n") - 1, F.lit(1))
        return CE.silhouette(_numbered(wide, key, "v"), table.withColumn("centroid", F.concat("mean", F.array(spread))), to_own, F.lit(0.0),
                             "euclidean", "silhouette_squared", key)
    own = F.col(key)
    return _silhouette(points, stats, key, "v", lambda x, z: F.when(
        (z["id"] == own) & (z["n"] <= 1), 0.0).otherwise(
        F.greatest(z["n"] * V.dot(x, x) - 2 * V.dot(x, z["s"]) + z["q"], F.lit(0.0))), "silhouette_squared")


# Numbers in the sample's vectors, which travel with every task: 128 MB.
MAX_SAMPLE_VALUES = 16_000_000


def hashed_sample(df: DataFrame, id_col: str, size: int, seed: int = L.KMEANS_SEED) -> DataFrame:
    """The ``size`` rows whose seeded MD5 of the id comes first (all rows of a smaller table); ties in the order of the id."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("_h")
    return df.withColumn("_h", h).orderBy("_h", id_col).limit(size).drop("_h")


def sampled_silhouettes(points: DataFrame, labels: list[str], sample: int = L.SILHOUETTE_SAMPLE, score_all: bool = False,
                        id_col: str = "id", vec: str = "vec") -> DataFrame:
    """(labelling, silhouette_euclidean, n_points): mean Euclidean silhouette of each label column of ``points``.

    Distances are taken to a seeded sample of at most ``sample`` points; scored are the points of the sample or, with
    ``score_all``, every point. Up to ``sample`` points this is the silhouette of all pairs. Beyond, the score of a
    sample of m differs from it by about sd / sqrt(m), sd being the deviation of the points' silhouettes: at most
    0.014 for m = 5,000. A point of a cluster with no other point in the sample scores 0; fewer than two clusters in the sample
    give -1. Ids are unique and labels are not null. Distances to the whole sample are one matrix product per block of points, shared by
    all labelings.
    """
    cols = [F.col(c).cast("int").alias(c) for c in labels]
    points = points.select(F.col(id_col).alias("id"), V.as_double(vec).alias("vec"), *cols)
    checkpoint_dir(points.sparkSession)
    chosen = hashed_sample(points, "id", sample).checkpoint(eager=True)
    rows = chosen.collect()
    y = np.array([r["vec"] for r in rows], np.float64)
    if y.size > MAX_SAMPLE_VALUES:
        raise ValueError(f"a sample of {y.size} numbers exceeds {MAX_SAMPLE_VALUES}; take a smaller one")
    ids = {r["id"]: k for k, r in enumerate(rows)}
    given = {c: np.unique(np.array([r[c] for r in rows], np.int64), return_inverse=True) for c in labels}
    y_norms = np.einsum("ij,ij->i", y, y) if len(rows) else y

    def scored(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                b = batch.slice(start, 512)
                x = _matrix(b["vec"])
                at = np.array([ids.get(i, -1) for i in b["id"].to_pylist()])
                d = np.sqrt(np.maximum(np.einsum("ij,ij->i", x, x)[:, None] - 2 * x @ y.T + y_norms, 0))
                inside = at >= 0
                d[np.flatnonzero(inside), at[inside]] = 0
                for c in labels:
                    names, member = given[c]
                    one_hot = np.zeros((len(y), len(names)))
                    one_hot[np.arange(len(y)), member] = 1
                    sums, n = d @ one_hot, one_hot.sum(axis=0)
                    own = np.searchsorted(names, b[c].to_numpy()).clip(max=len(names) - 1)
                    known = names[own] == b[c].to_numpy()
                    here = np.arange(len(x))
                    others = n[own] - inside
                    a = sums[here, own] / np.maximum(others, 1)
                    means = sums / n
                    means[here, own] = np.where(known, np.inf, means[here, own])
                    nearest = means.min(axis=1)
                    top = np.maximum(a, nearest)
                    s = np.where(known & (others > 0) & (top > 0), (nearest - a) / np.where(top > 0, top, 1), 0.0)
                    yield pa.RecordBatch.from_pydict({"labelling": [c], "s": [float(s.sum())], "n": pa.array([len(s)], pa.int64()),
                                                      "clusters": pa.array([len(names)], pa.int64())})

    if not rows:
        return points.sparkSession.createDataFrame([(c, -1.0, 0) for c in labels], "labelling string, silhouette_euclidean double, n_points bigint")
    # Blocks of the sample are spread over the tasks; its order by hash is as good as random.
    scoring = points if score_all else chosen.repartition(max(1, -(-len(rows) // 512)), "id")
    per = scoring.mapInArrow(scored, "labelling string, s double, n bigint, clusters bigint").groupBy("labelling").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("clusters").alias("clusters"))
    return per.select("labelling", F.when(F.col("clusters") < 2, -1.0).otherwise(F.col("s") / F.col("n")).alias("silhouette_euclidean"),
                      F.col("n").alias("n_points"))


# Points of a packed row, the most points and sums by cluster that a task scores, and rows of distances held at a time.
PAIR_BLOCK, PAIR_POINTS, PAIR_SUMS, PAIR_ROWS = 2048, 32_768, 8_000_000, 512


def silhouette_all_pairs(points: DataFrame, key: str = "cluster_id", vec: str = "vec") -> DataFrame:
    """One row (silhouette_euclidean, n_points): the mean Euclidean silhouette of all points from the distances of all pairs.

    Points are packed into blocks and the blocks dealt into groups; the task of a group holds its points and reads all blocks
    one by one, so its memory does not grow with the points. A point is a row. A member of a singleton scores 0, and so does a point
    without a label or a vector, which is no other's neighbour; fewer than two clusters give -1.
    """
    spark = points.sparkSession
    checkpoint_dir(spark)
    points = points.select(F.col(key).cast("int").alias("label"), V.as_double(vec).alias("vec"))
    total = points.count()
    points = points.where("label is not null and vec is not null")
    sizes = points.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLUSTERS + 1).collect()
    if len(sizes) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    if len(sizes) < 2:
        return spark.createDataFrame([(-1.0, total)], "silhouette_euclidean double, n_points bigint")
    names = np.array(sorted(r["label"] for r in sizes))
    n_of = np.array([r["n"] for r in sorted(sizes, key=lambda r: r["label"])], np.float64)
    n, most = int(n_of.sum()), max(256, min(PAIR_POINTS, PAIR_SUMS // len(names)))
    blocks = -(-n // min(PAIR_BLOCK, most))
    groups = min(blocks, max(-(-n // most), spark.sparkContext.defaultParallelism))

    def packed(batches):
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, PAIR_BLOCK):
                b = batch.slice(start, PAIR_BLOCK)
                yield pa.RecordBatch.from_pydict({"block": pa.array([(part << 20) + k], pa.int64()), "labels": [
                    np.searchsorted(names, b["label"].to_numpy()).astype(np.int32).tobytes()], "vecs": [_matrix(b["vec"]).tobytes()]})
                k += 1

    def scored(batches):
        held, place, x = [], {}, None
        for batch in batches:
            for side, block, labels, vecs in zip(*(batch[c].to_pylist() for c in ("side", "block", "labels", "vecs")), strict=True):
                labels = np.frombuffer(labels, np.int32)
                y = np.frombuffer(vecs, np.float64).reshape(len(labels), -1)
                if side == 0:
                    place[block] = sum(len(h[0]) for h in held)
                    held.append((labels, y))
                    continue
                if not held:
                    continue
                if x is None:
                    own, x = (np.concatenate(c) for c in zip(*held, strict=True))
                    x_norms, sums = np.einsum("ij,ij->i", x, x), np.zeros((len(x), len(names)))
                order = np.argsort(labels, kind="stable")
                clusters, first = np.unique(labels[order], return_index=True)
                y = y[order]
                y_norms = np.einsum("ij,ij->i", y, y)
                for start in range(0, len(x), PAIR_ROWS):
                    rows = slice(start, start + PAIR_ROWS)
                    d = np.sqrt(np.maximum(x_norms[rows, None] - 2 * x[rows] @ y.T + y_norms, 0))
                    if block in place:  # a point is at distance 0 from itself
                        at = order + place[block] - start
                        here = np.flatnonzero((at >= 0) & (at < len(d)))
                        d[at[here], here] = 0
                    sums[rows, clusters] += np.add.reduceat(d, first, axis=1)
        if x is not None:
            here, others = np.arange(len(x)), n_of[own] - 1
            a = sums[here, own] / np.maximum(others, 1)
            means = sums / n_of
            means[here, own] = np.inf
            b = means.min(axis=1)
            top = np.maximum(a, b)
            yield pa.RecordBatch.from_pydict({"s": [float(np.where((others > 0) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0).sum())]})

    table = points.repartition(blocks).mapInArrow(packed, "block bigint, labels binary, vecs binary").checkpoint(eager=True)
    group = F.pmod(F.shiftright("block", 20), F.lit(groups)).cast("int").alias("g")
    own = table.select(group, F.lit(0).alias("side"), "block", "labels", "vecs")
    every = table.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("side"), "block", "labels", "vecs")
    parts = own.unionByName(every).repartitionById(groups, F.col("g")).sortWithinPartitions("side").mapInArrow(scored, "s double")
    return parts.agg((F.sum("s") / F.lit(total)).alias("silhouette_euclidean"), F.lit(total).cast("bigint").alias("n_points"))


def silhouette_euclidean(df: DataFrame, key: str = "cluster_id", vec: str = "vec", id_col: str = "post_id",
                         sample: int | None = None, score_all: bool = False) -> DataFrame:
    """One row (silhouette_euclidean, n_points) of one labelling, from all pairs or, with ``sample``, by ``sampled_silhouettes``."""
    if sample is None:
        return silhouette_all_pairs(df, key, vec)
    return sampled_silhouettes(df, [key], sample, score_all, id_col, vec).drop("labelling")


def silhouettes(points: DataFrame, centres: dict, sample: int = L.SILHOUETTE_SAMPLE) -> dict:
    """Silhouette of the labelings that several sets of centres give to the same points (id, vec): {name: score}."""
    checkpoint_dir(points.sparkSession)
    labelled = hashed_sample(points, "id", sample).checkpoint(eager=True)
    for name, c in centres.items():
        labelled = LL.assign(labelled, [LL.Model("", len(c), 0, c)], None, "vec", f"_k{name}")
    rows = sampled_silhouettes(labelled, [f"_k{name}" for name in centres], sample).collect()
    return {r["labelling"][2:]: r["silhouette_euclidean"] for r in rows}


def word_table(docs: DataFrame, tokens_col: str, vec: str = "vec", min_docs: int = 2,
               only: DataFrame | None = None) -> DataFrame:
    """A (word, vector) table learned from the data: a word's vector is the mean vector of
    the documents that use it; words used by fewer than ``min_docs`` documents are dropped.
    ``only`` (a one-column ``word`` frame) restricts the table to the words needed."""
    if only is None:
        st = WT.sums(docs.where(F.col(vec).isNotNull()).select(F.array_distinct(tokens_col), V.as_double(vec)))
        return st.where(F.col("n") >= min_docs).select("word", F.transform("sum", lambda x: x / F.col("n")).alias("vector"))
    ex = docs.select(F.explode(F.array_distinct(tokens_col)).alias("word"), V.as_double(vec).alias("v"))
    ex = ex.join(only.select("word").distinct(), "word", "left_semi")
    st = cluster_stats(ex, "word", "v")
    return st.where(F.col("n") >= min_docs).select("word", F.col("mean").alias("vector"))


def _key_type(docs: DataFrame, key: str) -> str:
    return docs.schema[key].dataType.simpleString()


def mean_word_vectors(docs: DataFrame, tokens_col: str, words: DataFrame, key: str = "post_id",
                      dim: int | None = None) -> DataFrame:
    """Document vector = mean of the vectors of its tokens found in ``words`` (with repeats);
    a document with no known token gets a zero vector (``dim`` wide).

    Words and documents meet in blocks (``wordtable.meet``); what is shuffled by document is one sum per document and block.
    """
    words = stored(words.select("word", V.as_double("vector").alias("vector")), "words")
    width = words.agg(F.max(F.size("vector"))).first()[0] or 0
    m = WT.meet(docs, key, tokens_col, words, "vector", 8 * width, WT.vector_sums, f"key {_key_type(docs, key)}, n bigint, sum array<double>")
    st = m.groupBy("key").agg(F.sum("n").alias("n_matched"), vector_to_array(Summarizer.sum(array_to_vector("sum"))).alias("_s")).select(
        F.col("key").alias(key), "n_matched", F.transform("_s", lambda x: x / F.col("n_matched")).alias("doc_vector"))
    out = docs.select(key).join(st, key, "left")
    zero = F.array_repeat(F.lit(0.0), F.lit(dim)) if dim else F.array().cast("array<double>")
    return out.select(key, F.coalesce("n_matched", F.lit(0)).cast("bigint").alias("n_matched"),
                      F.coalesce("doc_vector", zero).alias("doc_vector"))


def bin_histograms(docs: DataFrame, tokens_col: str, bins: DataFrame, key: str = "post_id") -> DataFrame:
    """Long-form bag-of-bins: (key, bin, weight) with weight = count(bin) / matched tokens.

    Documents without a matched token keep one row with a null bin (their vector is zero). The totals come
    from the histogram itself; nothing is joined back. Words meet the documents in blocks (``wordtable.meet``).
    """
    bins = stored(bins.where("bin is not null").select("word", F.col("bin").cast("int").alias("bin")), "bins")
    per = WT.meet(docs, key, tokens_col, bins, "bin", 4, WT.value_counts, f"key {_key_type(docs, key)}, bin int, c bigint").withColumnRenamed("key", key)
    per = per.groupBy(key, "bin").agg(F.sum("c").alias("c"))
    known = F.when(F.col("bin").isNotNull(), F.struct("bin", "c"))
    h = per.groupBy(key).agg(F.collect_list(known).alias("h"), F.sum(F.when(F.col("bin").isNotNull(), F.col("c"))).alias("m"))
    return h.select(key, "m", F.explode_outer("h").alias("x")).select(
        key, F.col("x.bin").alias("bin"), (F.col("x.c") / F.col("m")).alias("weight"))


def densify(long: DataFrame, key: str, width: int) -> DataFrame:
    """(key, bin, weight) -> (key, array<double> of ``width``), zeros where absent."""
    g = long.groupBy(key).agg(F.map_from_entries(F.collect_list(
        F.when(F.col("bin").isNotNull(), F.struct(F.col("bin").cast("int"), F.col("weight"))))).alias("m"))
    return g.select(key, F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                                     lambda i: F.coalesce(F.col("m")[i], F.lit(0.0))).alias("vec"))
