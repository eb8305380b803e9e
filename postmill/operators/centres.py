"""Nearest centre, for any number of centres.

Centres of at most ``HELD_VALUES`` numbers travel with the tasks, and no point moves. Beyond that they stay a table. A
bounded, hashed sample of them (the pivots) divides the rest: each centre belongs to its nearest pivot, which knows how far its
centres reach. A point's best pivot bounds its answer from above (pivots are centres themselves), the triangle inequality
bounds the centres of each pivot from below, and the point goes only to blocks of centres that can still win. Blocks gather
neighbouring pivots up to a size; a pivot with more centres has several. Points and centres of a block meet as Arrow groups of
bounded size: a block that many points need is copied to as many groups. The winners, narrow rows, are merged by one
aggregate. The answer is exact. Where no block can be ruled out, each point moves once per ``HELD_VALUES`` numbers of centres.
Tasks are dealt by pairs of point and centre, not by bytes: a group is a task, and points that meet held centres are dealt anew.

Measures (``MEASURES``), all smaller is better; ties go to the lower key:

- ``euclidean``: squared distance.
- ``cosine``: minus the cosine similarity, with the library's epsilon in the denominator.
- ``dot``: minus the inner product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import vectors as V
from postmill.operators.lloyd import _matrix
from postmill.session import checkpoint_dir

MEASURES = ("euclidean", "cosine", "dot")
# Numbers in the centres or pivots that travel with every task, in a block of centres and in the points of one group (32 MB).
HELD_VALUES = 4_000_000
MAX_PIVOTS = 1_024
# Centres beyond which a scan's partition of points may be too long a task, and pairs of point and centre in one task then (some
# seconds), whatever the files of the points. A group in blocks has at most GROUP_PAIRS.
FEW_CENTRES, TASK_PAIRS, GROUP_PAIRS = 4_096, 1 << 28, 1 << 32
NO_KEY = -2**63  # stands for "no own cluster"
# Relative allowance for rounding; whatever lies within it is compared again in full precision.
SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _values(x: np.ndarray, c: np.ndarray, measure: str) -> np.ndarray:
    """Value of each centre (column) for each point (row), by one matrix product."""
    d = x @ c.T
    if measure == "euclidean":
        return np.maximum(np.einsum("ij,ij->i", x, x)[:, None] - 2 * d + np.einsum("ij,ij->i", c, c), 0)
    if measure == "cosine":
        d = d / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(c, axis=1) + L.COSINE_EPS)
    return -d


def _exact(x: np.ndarray, c: np.ndarray, measure: str) -> np.ndarray:
    """Value of pairs, row by row."""
    if measure == "euclidean":
        return ((x - c) ** 2).sum(axis=1)
    d = (x * c).sum(axis=1)
    if measure == "cosine":
        d = d / (np.linalg.norm(x, axis=1) * np.linalg.norm(c, axis=1) + L.COSINE_EPS)
    return -d


def _allowance(x: np.ndarray, c: np.ndarray, measure: str) -> np.ndarray:
    if measure == "cosine":
        return np.full(len(x), SLACK)
    widest = np.linalg.norm(c, axis=1).max(initial=0.0)
    lengths = np.linalg.norm(x, axis=1)
    return SLACK * ((lengths + widest) ** 2 if measure == "euclidean" else lengths * widest) + 1e-300


def _lower(x: np.ndarray, p: np.ndarray, radius: np.ndarray, measure: str) -> np.ndarray:
    """Least value that a centre of each pivot's block can have for each point."""
    if measure == "euclidean":
        return np.maximum(np.sqrt(_values(x, p, measure)) - radius, 0) ** 2
    if measure == "cosine":
        # The epsilon only shrinks a similarity, so a positive bound holds with it, and zero where there is none.
        return -np.maximum(_unit(x) @ _unit(p).T + radius, 0)
    return -(x @ p.T + np.linalg.norm(x, axis=1)[:, None] * radius)


def _best(x: np.ndarray, own: np.ndarray, c: np.ndarray, keys: np.ndarray, measure: str):
    """(value, key) of each point's best centre other than ``own``; an infinite value where there is none."""
    value, key = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
    step = max(16, min(256, 2_000_000 // max(len(c), 1)))  # some 16 MB of values at a time
    for a in range(0, len(x), step):
        xs = x[a:a + step]
        v = _values(xs, c, measure)
        mine = own[a:a + step]
        if (mine != NO_KEY).any():
            v[mine[:, None] == keys[None, :]] = np.inf
        least = v.min(axis=1)
        near = np.isfinite(v) & (v <= (least + 2 * _allowance(xs, c, measure))[:, None])
        i, j = np.nonzero(near)
        full = np.concatenate([_exact(xs[i[s:s + 16384]], c[j[s:s + 16384]], measure) for s in range(0, len(i), 16384)] or [np.zeros(0)])
        order = np.lexsort((keys[j], full, i))
        i, j, full = i[order], j[order], full[order]
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else i
        value[a + i[first]], key[a + i[first]] = full[first], keys[j[first]]
    return value, key


def _neighbours(p: np.ndarray) -> list[int]:
    """The rows in an order that keeps near ones together: halves along the widest axis, again and again."""
    order, todo = [], [np.arange(len(p))]
    while todo:
        rows = todo.pop()
        if len(rows) > 1:
            along = rows[np.argsort(p[rows, p[rows].var(axis=0).argmax()], kind="stable")]
            todo += [along[len(along) // 2:], along[:len(along) // 2]]
        else:
            order += rows.tolist()
    return order


def _spans(sizes: list[int], order: list[int], block: int) -> tuple[np.ndarray, np.ndarray]:
    """Per pivot the first of its blocks and the one after its last: small pivots share blocks, large ones have their own."""
    low, high = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    at, filled = 0, 0
    for q in order:
        if filled and filled + sizes[q] > block:
            at, filled = at + 1, 0
        low[q], high[q] = at, at + max(1, -(-sizes[q] // block))
        filled += sizes[q]
        if high[q] - low[q] > 1:
            at, filled = int(high[q]), 0
    return low, high


def _by_work(points: DataFrame, n_centres: int) -> DataFrame:
    """``points`` (id, ...) in partitions of about ``TASK_PAIRS`` pairs with centres: few bytes of points can be much work."""
    if n_centres <= FEW_CENTRES:
        return points
    parts = -(-points.count() * n_centres // TASK_PAIRS)
    return points.repartition(parts, "id") if parts > 1 else points


def nearest(points: DataFrame, centres: DataFrame, measure: str = "euclidean", id_col: str = "post_id", vec: str = "vec",
            key: str = "cluster_id", centroid: str = "centroid", own: str | None = None,
            max_pivots: int = MAX_PIVOTS, held_values: int = HELD_VALUES) -> DataFrame:
    """(id_col, nearest, value) of every point: its best centre by ``measure``, ties to the lower key.

    ``own`` names a column of the key that may not win (a point's own cluster). Ids and keys are unique, keys are
    whole numbers, all vectors have one width. A point with a null id or a null or empty vector, and one without any
    centre to choose, has no row. Other columns of ``points`` do not matter.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure {measure!r} is none of {MEASURES}")
    spark = points.sparkSession
    checkpoint_dir(spark)
    mine = F.coalesce(F.col(own).cast("bigint") if own else F.lit(None), F.lit(NO_KEY))
    single = points.schema[vec].dataType.simpleString() == "array<float>"  # half as wide on the way, widened in the task
    x = F.col(vec) if single else V.as_double(vec)
    p = points.select(F.col(id_col).alias("id"), mine.alias("own"), x.alias("x")).where("id is not null and size(x) > 0")
    id_type, x_type = (p.schema[n].dataType.simpleString() for n in ("id", "x"))
    result = f"id {id_type}, nearest bigint, value double"
    c = centres.select(F.col(key).cast("bigint").alias("key"), V.as_double(centroid).alias("c")).where("key is not null and size(c) > 0")
    c = c.checkpoint(eager=True)
    size = c.agg(F.max(F.size("c")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    width = size["width"]
    if not width:
        return spark.createDataFrame([], result).withColumnRenamed("id", id_col)
    block = max(1, held_values // width)
    if size["n"] <= block:
        rows = c.collect()
        held, names = np.array([r["c"] for r in rows], np.float64), np.array([r["key"] for r in rows], np.int64)

        def scored(batches):
            for batch in batches:
                value, k = _best(_matrix(batch["x"]), batch["own"].to_numpy(), held, names, measure)
                yield pa.RecordBatch.from_pydict({"id": batch["id"], "nearest": k, "value": value}).filter(pa.array(np.isfinite(value)))

        return _by_work(p, size["n"]).mapInArrow(scored, result).withColumnRenamed("id", id_col)

    chosen = c.orderBy(F.xxhash64("key"), "key").limit(max(2, min(max_pivots, block))).collect()
    pivots, names = np.array([r["c"] for r in chosen], np.float64), np.array([r["key"] for r in chosen], np.int64)

    def space(m):
        return _unit(m) if measure == "cosine" else m

    def to_block(batches):
        for batch in batches:
            m = space(_matrix(batch["c"]))
            d = _values(m, space(pivots), "euclidean")
            at = d.argmin(axis=1)
            far = np.sqrt(_exact(m, space(pivots)[at], "euclidean"))
            yield pa.RecordBatch.from_pydict({"key": batch["key"], "c": batch["c"], "pivot": pa.array(at, pa.int32()), "far": far})

    blocked = c.mapInArrow(to_block, "key bigint, c array<double>, pivot int, far double").checkpoint(eager=True)
    sizes = {r["pivot"]: r for r in blocked.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    radius = np.array([sizes[i]["far"] if i in sizes else -np.inf for i in range(len(names))])
    lows, highs = _spans([sizes[i]["n"] if i in sizes else 0 for i in range(len(names))], _neighbours(pivots), block)
    n_blocks = int(highs.max())
    low, high = (F.element_at(V.const(x.tolist(), "array<bigint>"), F.col("pivot") + 1) for x in (lows, highs))
    number = low + F.pmod(F.xxhash64("key"), F.greatest(high - low, F.lit(1)))
    # Which blocks hold centres of which pivot.
    holds = np.zeros((len(names), n_blocks), np.float32)
    for q, (a, b) in enumerate(zip(lows, highs)):
        holds[q, a:b] = 1
    blocked = blocked.select(number.alias("block"), "key", "c")
    # A zero vector has the value 0 with every centre unless distances count: the two lowest keys settle it.
    lowest = sorted({r["block"] for r in blocked.orderBy("key").limit(2).collect()})

    def to_blocks(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                b = batch.slice(start, 1024)
                x = _matrix(b["x"])
                mine = b["own"].to_numpy(zero_copy_only=False)
                upper = _values(x, pivots, measure)
                upper[mine[:, None] == names] = np.inf
                upper = upper.min(axis=1) + _allowance(x, pivots, measure)
                need = _lower(x, pivots, radius, measure) <= (upper + _allowance(x, pivots, measure))[:, None]
                zero = ~x.any(axis=1) & (measure != "euclidean")
                asked_for = need.astype(np.float32) @ holds > 0
                lists = [lowest if zero[i] else np.flatnonzero(asked_for[i]) for i in range(len(x))]
                yield pa.RecordBatch.from_pydict({"id": b["id"], "own": b["own"], "x": b["x"], "blocks": pa.array(lists, pa.list_(pa.int64()))})

    wanted = p.mapInArrow(to_blocks, f"id {id_type}, own bigint, x {x_type}, blocks array<bigint>").checkpoint(eager=True)
    asked = {r["block"]: r["n"] for r in wanted.select(F.explode("blocks").alias("block")).groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = max(1, min(block, GROUP_PAIRS // block))
    counts = [-(-asked.get(i, 1) // held) for i in range(n_blocks)]
    # Groups are numbered, and each is a task: hashed to the session's partitions, some tasks would hold many.
    first = np.concatenate([[0], np.cumsum(counts)])
    n, start = (F.element_at(V.const(x, "array<int>"), F.col("block").cast("int") + 1) for x in (counts, first[:-1].tolist()))
    left = wanted.select("id", "own", "x", F.explode("blocks").alias("block")).select(
        (start + F.pmod(F.xxhash64("id", F.lit(7)), n).cast("int")).alias("group"), "id", "own", "x")
    right = blocked.select(F.explode(F.sequence(start, start + n - 1)).alias("group"), "key", "c")
    left, right = (side.repartitionById(int(first[-1]), F.col("group")) for side in (left, right))

    def meet(points_: pa.Table, centres_: pa.Table) -> pa.Table:
        if not points_.num_rows or not centres_.num_rows:
            return pa.table({"id": points_["id"].slice(0, 0), "value": pa.array([], pa.float64()), "key": pa.array([], pa.int64())})
        value, k = _best(_matrix(points_["x"].combine_chunks()), points_["own"].to_numpy(), _matrix(centres_["c"].combine_chunks()),
                         centres_["key"].to_numpy(), measure)
        found = np.isfinite(value)
        return pa.table({"id": points_["id"].filter(pa.array(found)), "value": value[found], "key": k[found]})

    met = left.groupBy("group").cogroup(right.groupBy("group")).applyInArrow(
        meet, f"id {id_type}, value double, key bigint")
    best = met.groupBy("id").agg(F.min(F.struct("value", "key")).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("b.key").alias("nearest"), F.col("b.value").alias("value"))


def silhouette(points: DataFrame, stats: DataFrame, mean_to_own: Column, offset: Column, measure: str, out: str, key: str, **sizes) -> DataFrame:
    """Mean silhouette from cluster statistics that stay a table.

    ``points`` has (id, key, x), ``stats`` (key, n, centroid and what the columns read). ``mean_to_own`` is a point's mean distance
    to the others of its cluster; a point's mean distance to cluster z is the measure's value plus ``offset``. A member of a
    singleton scores 0, and so does a point at distance 0 from both; fewer than two clusters give -1.
    """
    checkpoint_dir(points.sparkSession)
    points, stats = points.checkpoint(eager=True), stats.checkpoint(eager=True)
    if stats.limit(2).count() < 2:
        return points.agg(F.lit(-1.0).alias(out), F.count(F.lit(1)).alias("n_points"))
    other = nearest(points, stats, measure, "id", "x", key, "centroid", own=key, **sizes)
    a = points.join(stats, key).select("id", "n", mean_to_own.alias("a"))
    both = a.join(other, "id").select("n", "a", (F.col("value") + offset).alias("b"))
    top = F.greatest("a", "b")
    s = F.when((F.col("n") <= 1) | (top == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.nullif(top, F.lit(0.0)))
    return both.agg(F.avg(s).alias(out), F.count(F.lit(1)).alias("n_points"))
