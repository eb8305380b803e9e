"""Merkle manifest of a dataset: a tree of arity three per group (source), and one over the groups' roots.

A leaf's place in its group is its rank by id. No group is sorted for it: the ids of a group are merged into a
bitmap of 64-bit words (only words with an id are kept, cut into chunks of 4,096 ids), a popcount directory holds
how many rows lie before each chunk and each word, and a rank query is the directory's number and the bits below
the id's own. Ranks are coordinates: node k of a level is slot ``k mod 3`` of node ``k div 3`` above, so levels are
reduced by keyed slot arrays, ``LEVELS`` at a time: 2,187 leaves share a key, and a task needs no other ones.
On the way back each node gets the siblings on its path (``left`` and ``right`` of each level).
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import cut

ARITY = 3
# Levels that one grouping reduces: a group holds at most ARITY ** LEVELS nodes.
LEVELS = 7
SPAN = ARITY ** LEVELS
# Words of a chunk and chunks of a stretch, as powers of two; a word has 64 ids.
CHUNK, STRETCH = 6, 12
# Comes before the word of any id.
NULL_WORD = -(1 << 57) - 1


def encoded(c: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value (integers in decimal)."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in fields]), 256)


def _word(key: Column) -> Column:
    return F.coalesce(F.shiftright(key, 6), F.lit(NULL_WORD))


def _bit(key: Column) -> Column:
    return F.coalesce(key.bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def directory(ids: DataFrame) -> DataFrame:
    """(tree, word, bits, more, before): the bitmaps of the trees' ids with their popcount directory.

    ``ids`` has (tree, key, c): the distinct ids with the rows of each. ``more`` lists the bits of ids with further
    rows and how many; ``before`` is the rows of smaller words. Counts run within chunks, over the chunks of a
    stretch (16.8 million ids), and over a tree's stretches.
    """
    one = F.expr("shiftleft(1L, bit)")
    w = ids.select("tree", _word(F.col("key")).alias("word"), _bit(F.col("key")).alias("bit"), "c").groupBy("tree", "word").agg(
        F.bit_or(one).alias("bits"), F.collect_list(F.when(F.col("c") > 1, F.struct("bit", (F.col("c") - 1).alias("c")))).alias("more"),
        F.sum("c").alias("n"))
    w = cut(w.withColumn("chunk", F.shiftright("word", CHUNK)).withColumn("stretch", F.shiftright("chunk", STRETCH)))

    def running(df: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum("n").over(before), F.lit(0)))

    chunks = w.groupBy("tree", "stretch", "chunk").agg(F.sum("n").alias("n"))
    stretches = running(chunks.groupBy("tree", "stretch").agg(F.sum("n").alias("n")), ["tree"], "stretch", "s_before").drop("n")
    chunks = running(chunks, ["tree", "stretch"], "chunk", "c_before").join(stretches, ["tree", "stretch"])
    chunks = chunks.select("tree", "chunk", (F.col("c_before") + F.col("s_before")).alias("c_before"))
    w = running(w, ["tree", "chunk"], "word", "w_before").join(chunks, ["tree", "chunk"])
    return w.select("tree", "word", "bits", "more", (F.col("w_before") + F.col("c_before")).alias("before"))


def ranked(rows: DataFrame, extra: list[str]) -> DataFrame:
    """(tree, key, digest, *extra, idx): every row with its rank in its tree by (key, digest); null keys come first.

    ``rows`` may hold equal rows; they take consecutive ranks, in any order. One row per input row.
    """
    # Equal rows are one row with a count until the end; a key with several digests deals out its ranks in their order.
    r = cut(rows.groupBy("tree", "key", "digest", *extra).agg(F.count(F.lit(1)).alias("n")))
    ids = r.groupBy("tree", "key").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("kinds"))
    several = ids.where("kinds > 1").select(F.col("tree").alias("t"), F.col("key").alias("k"))
    same = (F.col("tree") == F.col("t")) & F.col("key").eqNullSafe(F.col("k"))
    order = Window.partitionBy("tree", "key").orderBy("digest", *extra).rowsBetween(Window.unboundedPreceding, -1)
    tied = r.join(several, same, "left_semi").withColumn("tie", F.coalesce(F.sum("n").over(order), F.lit(0)))
    r = r.join(several, same, "left_anti").withColumn("tie", F.lit(0).cast("long")).unionByName(tied)
    r = r.withColumn("word", _word(F.col("key"))).withColumn("bit", _bit(F.col("key"))).join(directory(ids), ["tree", "word"])
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    more = F.aggregate(F.filter("more", lambda x: x["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda a, x: a + x["c"])
    r = r.withColumn("first", F.col("before") + below + more + F.col("tie"))
    return r.select("tree", "key", "digest", *extra, F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("idx"))


def _h(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _levels(digests: list[str], n: int) -> list[list[str]]:
    """The levels of one group, from its nodes up to its top; ``n`` is the number of nodes in the whole tree."""
    levels = [digests]
    while n > 1 and len(levels) <= LEVELS:
        d = levels[-1]
        levels.append([_h(d[k:k + ARITY]) for k in range(0, len(d), ARITY)])
        n = -(-n // ARITY)
    return levels


def _slots(group: pa.Table) -> tuple[np.ndarray, list[str]]:
    """(slot of each row, digests by slot) of a group."""
    slot = group["idx"].to_numpy() % SPAN
    digests: list = [None] * len(slot)
    for s, d in zip(slot.tolist(), group["digest"].to_pylist()):
        digests[s] = d
    return slot, digests


def _block(df: DataFrame) -> DataFrame:
    return df.withColumn("block", F.floor(F.col("idx") / SPAN).cast("long"))


def climb(nodes: DataFrame, n_max: int) -> tuple[list[DataFrame], DataFrame]:
    """Reduce the levels: (the nodes of every round, the roots), each (tree, idx, digest, n).

    ``n`` is the number of nodes of the whole tree in that round, ``n_max`` the largest of all trees.
    """
    def top(key, group):
        n = group["n"][0].as_py()
        return pa.table({"tree": [key[0].as_py()], "idx": [key[1].as_py()], "digest": [_levels(_slots(group)[1], n)[-1][0]], "n": [-(-n // SPAN)]})

    rounds = [nodes]
    while True:
        done = n_max <= SPAN
        up = _block(rounds[-1].select("tree", "idx", "digest", "n")).groupBy("tree", "block").applyInArrow(
            top, "tree string, idx long, digest string, n long")
        rounds.append(cut(up))
        n_max = -(-n_max // SPAN)
        if done:
            return rounds[:-1], rounds[-1]


PATH = "array<struct<left:string,right:string>>"
_ARROW_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _paths(slot: np.ndarray, digests: list[str], n: int):
    """Per row the siblings on the way to the group's top, as (left, right) by level, each joined."""
    levels = _levels(digests, n)[:-1]
    for s in slot.tolist():
        path = []
        for d in levels:
            run = s - s % ARITY
            path.append({"left": "".join(d[run:s]), "right": "".join(d[s + 1:run + ARITY])})
            s //= ARITY
        yield path


def descend(rounds: list[DataFrame], roots: DataFrame, finish, schema: str) -> DataFrame:
    """From the roots (tree, path, *anything) down to the first round's rows, each with its whole path.

    ``finish(rows, paths, top)`` makes the result of a group of rows: a table of ``schema`` from the group's rows,
    the rows' paths inside the group, and the one row (as dict) of what lies above.
    """
    above = roots.withColumn("idx", F.lit(0).cast("long"))
    others = [c for c in above.columns if c not in ("tree", "idx", "path")]

    def step(rows, paths, top):
        return pa.table({"tree": rows["tree"], "idx": rows["idx"],
                         "path": pa.array([p + top["path"] for p in paths], _ARROW_PATH),
                         **{c: [top[c]] * len(rows) for c in others}})

    def meet(make):
        def met(rows, tops):
            slot, digests = _slots(rows)
            return make(rows, _paths(slot, digests, rows["n"][0].as_py()), tops.slice(0, 1).to_pylist()[0])

        return met

    for k, nodes in enumerate(reversed(rounds)):
        last = k == len(rounds) - 1

        out = schema if last else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in above.select("tree", "idx", "path", *others).schema)
        met = _block(nodes).groupBy("tree", "block").cogroup(above.withColumnRenamed("idx", "block").groupBy("tree", "block"))
        above = met.applyInArrow(meet(finish if last else step), out)
        if not last:
            above = cut(above)
    return above


def fold(digest: str, path: list[dict]) -> str:
    """The root that a digest and its siblings give."""
    for p in path:
        digest = _h([p["left"], digest, p["right"]])
    return digest


def _numbered(sources: DataFrame) -> DataFrame:
    """(tree, idx) of distinct trees in order of their names, numbered by range partition: no task holds them all."""
    s = cut(sources.select("tree").distinct().orderBy("tree")).withColumn("at", F.monotonically_increasing_id())
    s = s.withColumn("part", F.shiftright("at", 33)).withColumn("k", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sorted((r["part"], r["count"]) for r in s.groupBy("part").count().collect())
    before, rows = 0, []
    for part, n in sizes:
        rows.append((part, before))
        before += n
    base = s.sparkSession.createDataFrame(rows, "part long, base long")
    return s.join(F.broadcast(base), "part").select("tree", (F.col("k") + F.col("base")).alias("idx"))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple = ("doc_id", "source", "lang", "n_chars", "text"),
             text_col: str = "text") -> DataFrame:
    """One row per input row: (id, leaf, subroot, root, proof_sha256, folded_root, verified).

    A leaf is the SHA-256 of the encoded ``fields``. Leaves of a group are ordered by id (null first), equal ids by
    leaf; groups by the UTF-8 bytes of their name, null first. ``verified`` tells whether the row as found now
    folds to the root; here every row whose unsigned crc32 of the decimal id is even is folded with its text's
    newlines deleted (a null id is not). Repeated rows are leaves of their own. A lone leaf is its group's
    root, a lone group's root is the root; an empty table gives no rows.
    """
    changed = F.when(F.crc32(F.col(id_col).cast("string")) % 2 == 0, F.translate(F.col(text_col), "\n", "")).otherwise(F.col(text_col))
    # 's' before the name keeps a null group ('') apart from an empty name, and first in order.
    rows = docs.select(F.coalesce(F.concat(F.lit("s"), F.col(group_col).cast("string")), F.lit("")).alias("tree"),
                       F.col(id_col).cast("long").alias("key"), leaf(*[F.col(c) for c in fields]).alias("digest"),
                       leaf(*[changed if c == text_col else F.col(c) for c in fields]).alias("found"))
    leaves = ranked(rows, ["found"])
    counts = cut(leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n")))
    leaves = cut(leaves.join(counts, "tree"))
    most = counts.agg(F.max("n"), F.count(F.lit(1))).first()
    rounds, subroots = climb(leaves, most[0] or 0)
    order = _numbered(counts)
    groups = subroots.select("tree", "digest").join(order, "tree").select(
        F.lit("").alias("tree"), "idx", "digest", F.lit(most[1]).cast("long").alias("n"), F.col("tree").alias("group"))
    g_rounds, root = climb(groups, most[1])

    def group_path(rows, paths, top):
        return pa.table({"tree": rows["group"], "subroot": rows["digest"], "root": [top["root"]] * len(rows),
                         "path": pa.array([p + top["path"] for p in paths], _ARROW_PATH)})

    def proven(rows, paths, top):
        out = {c: [] for c in ("proof_sha256", "folded_root")}
        for found, p in zip(rows["found"].to_pylist(), paths):
            p = p + top["path"]
            out["proof_sha256"].append(_h([x[side] for x in p for side in ("left", "right")]))
            out["folded_root"].append(fold(found, p))
        n = len(rows)
        return pa.table({"id": rows["key"], "leaf": rows["digest"], "subroot": [top["subroot"]] * n, "root": [top["root"]] * n, **out,
                         "verified": [x == top["root"] for x in out["folded_root"]]})

    tops = root.select("tree", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    tops = cut(descend(g_rounds, tops, group_path, f"tree string, subroot string, root string, path {PATH}"))
    out = descend(rounds, tops, proven, "id long, leaf string, subroot string, root string, proof_sha256 string, "
                                        "folded_root string, verified boolean")
    return out.withColumnRenamed("id", id_col)
