"""Benchmark decontamination: item-sized windows, SimHash, multi-index Hamming blocks, exact check.

A document is contaminated by an item when some window of the item's length has a weighted Jaccard
similarity (of shingle multisets) of at least ``similarity`` with it. Windows are laid at every start;
left out are only those with too few positions of the item's shingles to reach the similarity in any
order. Each window gets a SimHash fingerprint of its shingles, each with the number of its occurrence, so
that equal similarity means equal distance whether or not shingles repeat.
The radius follows the item's length: a short item's fingerprint differs by more bits at the same
similarity. It is the distance that a window of sufficient similarity exceeds with a probability below
``LOSS``, whatever the window's length. An item has one block of bits more than its radius as index:
fingerprints within the radius agree on at least one block, so the join on (item, block, bits) misses
none of them. Candidates within the radius are verified by exact weighted-shingle similarity. Only
DataFrame functions are used.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.common import let
from postmill.llm.common import bitmap, cut, flagged, settle, text_or_empty

SHINGLE = 5
SIMILARITY = 0.8
BITS = 64
# The chance that a true match lies beyond the radius, and the length from which on the radius stays.
LOSS = 1e-7
LONGEST = 512
# The shingles of the benchmark are broadcast up to this many rows of three longs (48 MB); beyond it they
# are shuffled to the documents' shingles.
BROADCAST_ROWS = 1_000_000


def words(text: str) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text_or_empty(text)), "[^\\p{L}\\p{N}]+"), lambda x: x != "")


def shingles(ws: Column) -> Column:
    """64-bit hash of every run of five words, by position; shorter texts have one, empty ones none."""
    def runs(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - SHINGLE + 1, F.lit(1))),
                           lambda i: F.xxhash64(F.slice(h, i, SHINGLE)))

    # The word hashes are bound once; a lambda would otherwise take them anew for each position.
    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: F.when(F.size(h) > 0, runs(h)).otherwise(F.expr("cast(array() as array<bigint>)")))


def _bits(h: Column, shift: Column, mask: Column) -> Column:
    return F.call_function("shiftrightunsigned", h, shift).bitwiseAND(mask)


def simhash(hashes: Column) -> Column:
    """Fingerprint of an array of hashes, repeats included: a bit is set in over half of them."""
    one = F.lit(1).cast("long")

    def add(fp: Column, bit: Column) -> Column:
        count = F.size(F.filter(hashes, lambda h: _bits(h, bit, one) == 1))
        return fp.bitwiseOR(F.call_function("shiftleft", (2 * count > F.size(hashes)).cast("long"), bit))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), add)


def numbered(hashes: Column) -> Column:
    """Each hash with the number of its occurrence, hashed again: as a set, what the array is as a multiset."""
    def hashed(hs: Column) -> Column:
        nth = F.transform(hs, lambda h, i: F.xxhash64(h, i - F.array_position(hs, h).cast("int") + 2))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.transform(hs, lambda h: F.xxhash64(h, F.lit(1)))).otherwise(nth)

    return let(F.sort_array(hashes), hashed)


def fingerprint(hashes: Column) -> Column:
    """SimHash of a multiset: repeats count as elements of their own, as they do in the weighted similarity."""
    return let(numbered(hashes), simhash)


def _binomial(n: int, p: float = 0.5) -> np.ndarray:
    """Probabilities of 0 to n successes."""
    k = np.arange(n + 1)
    if p in (0.0, 1.0):
        return (k == n * p).astype(float)
    logs = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(n + 1)])
    return np.exp(logs + k * math.log(p) + (n - k) * math.log1p(-p))


def bit_difference(shared: int, own: int, other: int) -> float:
    """The chance that one fingerprint bit of two sets differs: ``shared`` elements in both, the others in one of them."""
    ones, chance = np.arange(shared + 1), []
    for more in (own, other):
        above = np.r_[np.cumsum(_binomial(more)[::-1])[::-1], 0.0]
        # Set when over half of the set's bits are: the least number of further ones that suffices.
        least = np.floor((shared + more) / 2).astype(int) + 1 - ones
        chance.append(np.where(least <= 0, 1.0, above[np.clip(least, 0, more + 1)]))
    a, b = chance
    return float((_binomial(shared) * (a * (1 - b) + (1 - a) * b)).sum())


def radius(n: int, similarity: float = SIMILARITY, loss: float = LOSS) -> int:
    """The distance that a window similar enough to an item of ``n`` shingles exceeds with a probability below ``loss``.

    Bits are independent, so the distance is binomial; of all window lengths the one that differs most is taken.
    """
    worst = 0.0
    for width in range(1, n + 1):
        shared = next((s for s in range(1, width + 1) if s >= similarity * (width + n - s) - 1e-9), None)
        if shared:
            worst = max(worst, bit_difference(shared, width - shared, n - shared))
    beyond = 1 - np.cumsum(_binomial(BITS, min(worst, 1.0)))
    return int(np.argmax(beyond < loss))


def blocks(fp: Column, r: Column) -> Column:
    """Array of (block, bits): ``r`` + 1 blocks that part the fingerprint."""
    def cut_at(k: Column) -> Column:
        return F.floor(k * BITS / (r + 1)).cast("int")

    def one(k: Column) -> Column:
        width = cut_at(k + 1) - cut_at(k)
        mask = F.when(width >= BITS, F.lit(-1).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), width) - 1)
        return F.struct(k.alias("block"), _bits(fp, cut_at(k), mask).alias("bits"))

    return F.transform(F.sequence(F.lit(0), r), one)


def jaccard(both: Column, a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two multisets of sizes ``a`` and ``b`` that share ``both``."""
    return both / (a + b - both)


def starts(ps: Column, n: Column, m: Column, similarity: float) -> Column:
    """Array of (lo, hi): disjoint ranges of all starts whose windows can reach ``similarity`` with an item.

    ``ps`` are the ascending positions of the item's shingles in a text of ``m`` shingles, ``n`` the item's
    length. A window shares at most the positions inside it. ``k`` of them are the least that can suffice, and
    the windows that hold k neighbouring positions, from a to b, start from b - width + 1 to a.
    """
    width, last = F.least(n, m), F.greatest(m - n, F.lit(0))
    least = F.get(F.filter(F.sequence(F.greatest(F.floor(width * similarity).cast("int"), F.lit(1)), width),
                           lambda k: jaccard(k, width, n) >= similarity), F.lit(0))

    def ranges(ps: Column, k: Column) -> Column:
        def one(i: Column) -> Column:
            lo = F.greatest(F.get(ps, i + k - 1) - width + 1, F.coalesce(F.get(ps, i - 1) + 1, F.lit(0)), F.lit(0))
            return F.struct(lo.alias("lo"), F.least(F.get(ps, i), last).alias("hi"))

        return F.filter(F.transform(F.sequence(F.lit(0), F.size(ps) - k), one), lambda r: r["lo"] <= r["hi"])

    return let(F.struct(ps.alias("ps"), least.alias("k")), lambda x: F.when(F.size(x["ps"]) >= x["k"], ranges(x["ps"], x["k"])))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Contaminated rows by item: (id, item id, similarity, window_start, n_shingles, text_digest).

    One row per input row and item whose best window reaches ``similarity``; ``window_start`` is the
    first best window's word position, ``text_digest`` the SHA-256 of the text. Documents shorter
    than the item are one window. Null or empty texts on either side match nothing; repeated rows
    are reported each, repeated items (equal id and text) count once.
    """
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("t")).distinct()
    items = items.select("item", shingles(words("t")).alias("ish")).where(F.size("ish") > 0).distinct()
    # Items are numbered by content, so that null and repeated item ids stay apart.
    items = cut(items.select("item", F.xxhash64("item", "ish").alias("ikey"), F.size("ish").alias("n"), "ish", fingerprint(F.col("ish")).alias("ifp")))
    lengths = [x[0] for x in items.select(F.least("n", F.lit(LONGEST))).distinct().collect()]
    reach = F.create_map(*[F.lit(v) for n in lengths for v in (n, radius(n, similarity))]) if lengths else F.lit(None).cast("map<int,int>")
    items = items.withColumn("r", reach[F.least("n", F.lit(LONGEST))])
    seeds = items.select("ikey", "n", "r", F.explode(F.array_distinct("ish")).alias("h"))
    held = F.broadcast if seeds.count() <= BROADCAST_ROWS else (lambda df: df)
    # Positions of an item's shingles in a text, without the text; equal rows have equal ones.
    digest = F.sha2(text_or_empty(text_col), 256)
    d = docs.select(F.col(id_col).alias("id"), digest.alias("digest"), shingles(words(text_col)).alias("sh"))
    at = d.select("id", "digest", F.size("sh").alias("m"), F.posexplode("sh").alias("p", "h")).join(held(seeds), "h")
    laid = at.groupBy("id", "digest", "ikey", "n", "r", "m").agg(F.sort_array(F.collect_set("p")).alias("ps"))
    laid = laid.select(F.col("id").alias("l_id"), F.col("digest").alias("l_digest"), "ikey", "n", "r",
                       starts(F.col("ps"), F.col("n"), F.col("m"), similarity).alias("starts"))
    laid = cut(laid.where(F.size("starts") > 0))
    # Only texts with a window to lay are shingled again, row by row.
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), digest.alias("digest"), F.monotonically_increasing_id().alias("row"))
    d = flagged(d, bitmap(laid, "l_digest"), "digest").where("__llm_maybe")
    d = d.join(laid, (F.col("digest") == F.col("l_digest")) & F.col("id").eqNullSafe(F.col("l_id")))
    d = d.select("id", "row", "digest", "ikey", "n", "r", "starts", shingles(words("text")).alias("sh"))
    d = d.select("id", "row", "digest", "ikey", "n", "r", "sh", F.inline("starts"))
    win = d.select("id", "row", "digest", "ikey", "n", "r", "sh", F.explode(F.sequence("lo", "hi")).alias("start"))
    win = win.select("id", "row", "digest", "ikey", "r", "start", F.slice("sh", F.col("start") + 1, F.col("n")).alias("wsh"))
    win = cut(win.withColumn("wfp", fingerprint(F.col("wsh"))))
    # Multi-index join, then the radius.
    index = items.select("ikey", "ifp", F.inline(blocks(F.col("ifp"), F.col("r"))))
    probe = win.select("row", "ikey", "start", "wfp", "r", F.inline(blocks(F.col("wfp"), F.col("r"))))
    small = (items.agg(F.sum(F.col("r") + 1)).first()[0] or 0) <= BROADCAST_ROWS
    near = (probe.join(F.broadcast(index) if small else index, ["ikey", "block", "bits"])
            .where(F.bit_count(F.col("wfp").bitwiseXOR(F.col("ifp"))) <= F.col("r"))
            .select("row", "ikey", "start").distinct())
    # Exact weighted similarity of the survivors.
    survivors = win.join(near, ["row", "ikey", "start"])
    weights = (survivors.select("row", "ikey", "start", F.explode("wsh").alias("h"))
               .groupBy("row", "ikey", "start", "h").agg(F.count(F.lit(1)).alias("cw")))
    item_weights = items.select("ikey", F.explode("ish").alias("h")).groupBy("ikey", "h").agg(F.count(F.lit(1)).alias("ci"))
    shared = (weights.join(held(item_weights), ["ikey", "h"]).groupBy("row", "ikey", "start")
              .agg(F.sum(F.least("cw", "ci")).alias("both")))
    scored = survivors.join(shared, ["row", "ikey", "start"]).join(held(items.select("ikey", "item", "n")), "ikey")
    scored = scored.withColumn("sim", jaccard(F.col("both"), F.size("wsh"), F.col("n"))).where(F.col("sim") >= similarity)
    best = scored.groupBy("id", "row", "item", "ikey", "n", "digest").agg(
        F.max(F.struct(F.col("sim"), (-F.col("start")).alias("s"))).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("b.sim").alias("similarity"),
                       (-F.col("b.s")).cast("long").alias("window_start"), F.col("n").cast("long").alias("n_shingles"),
                       F.col("digest").alias("text_digest"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that any benchmark item contaminates; all columns stay as they were."""
    found = contaminated(docs, benchmark, id_col, text_col)
    drop = found.select(F.struct(F.col(id_col).alias("id"), F.col("text_digest").alias("digest")).alias("key"), F.lit(False).alias("keep"))
    return settle(docs, drop, id_col, text_col)
