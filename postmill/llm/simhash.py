"""SimHash near-duplicates: bit-sliced comparison of 64-bit fingerprints.

Fingerprints that differ in at most ``radius`` bits agree on at least ``BLOCKS - radius`` of
``BLOCKS`` blocks of bits, so every such pair shares a key made of that many blocks. Distinct
fingerprints meet on these keys. Inside a key's bucket, many pairs are compared at once: the
differences are turned into vertical bit planes (one bit per pair), carry-save counters add up the
planes, and a block of pairs is abandoned once all its counters exceed the radius. A bucket gives back
a spanning forest of its links, not its pairs; connected components join the forests.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import cut, row_key, settle, text_or_empty
from postmill.llm.components import components

SEED = 42
# With 6 blocks and radius 4, two blocks (21 or 22 bits) always agree: 15 keys per fingerprint.
BLOCKS = 6
# Rows of one bucket that are compared in one piece; larger buckets are dealt out in pairs of pieces.
PIECE = 4096
# Pairs per bit-sliced block.
LANES = 1 << 16
# Fingerprint copies per comparison task, on average.
TASK_ROWS = 200_000

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash over the XXH64 (seed 42) of all word shingles, repeats included; no word: zero.

    Words are runs without space and ASCII control blanks; shorter texts are one shingle. A bit is set
    when it is set in more than half of the hashes.
    """
    from xxhash import xxh64_intdigest

    # bytes.split() parts at the space and \\t \\n \\v \\f \\r, the six blanks of the word rule.
    words = (text or "").encode("utf-8").translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    last = ends[min(shingle, len(words)) - 1:] - 1
    first = (ends - sizes)[:n]
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first.tolist(), last.tolist())), np.uint64, n)
    total = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        part = hashes[lo:lo + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * total > n).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("id"), fp(text_or_empty(text_col)).alias("fp"))


def within(x: np.ndarray, radius: int) -> np.ndarray:
    """Which of the differences ``x`` (uint64) have at most ``radius`` bits set, bit-sliced.

    Counters are kept vertically: bit k of all lanes' counters is one packed array. A plane is added
    by rippling its carry upwards (a carry-save step per counter bit); ``over`` remembers lanes whose
    counter has passed the radius.
    """
    out = np.empty(len(x), bool)
    width = (radius + 1).bit_length()
    for lo in range(0, len(x), LANES):
        lanes = x[lo:lo + LANES]
        n = len(lanes)
        octets = np.ascontiguousarray(lanes).view(np.uint8).reshape(n, 8)
        counters = [np.zeros((n + 7) // 8, np.uint8) for _ in range(width)]
        over = np.zeros((n + 7) // 8, np.uint8)
        full = np.packbits(np.ones(n, np.uint8))
        for k in range(8):
            planes = np.packbits(np.unpackbits(octets[:, k:k + 1], axis=1).T, axis=1)
            for carry in planes:
                for j in range(width):
                    counters[j], carry = counters[j] ^ carry, counters[j] & carry
                over |= carry
            # radius + 1 <= counter in vertical form: compare from the top bit down.
            more, equal = np.zeros_like(over), np.full_like(over, 255)
            for j in reversed(range(width)):
                if (radius + 1) >> j & 1:
                    equal = equal & counters[j]
                else:
                    more |= equal & counters[j]
                    equal = equal & ~counters[j]
            over |= more | equal
            if not (full & ~over).any():
                break
        out[lo:lo + n] = np.unpackbits(over, count=n) == 0
    return out


def _forest(group: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (i, j) of a spanning forest of every group; rows are sorted by group.

    Pairs are taken by distance in the sorted order: row k against row k + d, for all groups at once.
    Pairs that earlier links already connect are not compared again.
    """
    n = len(fps)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    end = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
    parent = np.arange(n)
    links = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def roots(at: np.ndarray) -> np.ndarray:
        r = parent[at]
        while (up := parent[r] != r).any():
            r = np.where(up, parent[r], r)
        parent[at] = r
        return r

    at, d = np.arange(n), 1
    while len(at := at[at + d < end[at]]):
        apart = roots(at) != roots(at + d)
        a, b = at[apart], at[apart] + d
        near = within(fps[a] ^ fps[b], radius)
        for i, j in zip(a[near].tolist(), b[near].tolist()):
            p, q = root(i), root(j)
            if p != q:
                parent[max(p, q)] = min(p, q)
                links.append((i, j))
        d += 1
    return links


def _block_masks() -> list[int]:
    cuts = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Edges (src, dst) among the distinct fingerprints ``fp``: enough to connect all pairs within ``radius``.

    Each fingerprint goes to one bucket per combination of blocks. A bucket of more than ``PIECE``
    rows is dealt out: its rows get a piece number, and every pair of pieces is one group, so any two
    rows of the bucket still meet and no group exceeds two pieces.
    """
    if radius >= BLOCKS:
        raise ValueError(f"radius must be below {BLOCKS}")
    masks = _block_masks()
    keys = []
    for c, combo in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        mask = sum(masks[k] for k in combo)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.xxhash64(F.lit(c), F.col("fp").bitwiseAND(F.lit(signed).cast("long"))))
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, "key")
    # Piece numbers from a hash of the fingerprint: even, and the same when a task runs again.
    n_pieces = F.ceil(F.col("n") / PIECE).cast("int")
    rows = rows.withColumn("pieces", n_pieces).withColumn("piece", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("pieces")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    rows = rows.withColumn("other", other)
    rows = rows.select("fp", F.xxhash64("key", F.least("piece", "other"), F.greatest("piece", "other")).alias("grp"))
    rows = cut(rows)
    tasks = max(1, -(-rows.count() // TASK_ROWS))
    rows = rows.withColumn("task", F.pmod("grp", F.lit(tasks)))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["grp", "fp"], kind="stable")
        f = pdf["fp"].to_numpy()
        found = _forest(pdf["grp"].to_numpy(), f.view(np.uint64), radius)
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pd.DataFrame({"src": f[pairs[:, 0]], "dst": f[pairs[:, 1]]})

    e = rows.groupBy("task").applyInPandas(compare, "src long, dst long")
    return e.where("src != dst").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: (id, fingerprint as 16 hex digits, component_id).

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing bits,
    the row's own included; equal fingerprints are linked. Null text counts as empty, its fingerprint
    zero is linked like any other. Null ids are ignored as component ids unless a component has no other.
    """
    fps = cut(fingerprints(docs, shingle, id_col, text_col))
    # Copies and equal fingerprints collapse here, before any comparison.
    distinct = fps.groupBy("fp").agg(F.min("id").alias("first_id"))
    edges = cut(links(distinct.select("fp"), radius))
    comp = components(edges)  # (node, root)
    labelled = distinct.join(comp, distinct["fp"] == comp["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    roots = labelled.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id"))
    by_fp = labelled.join(roots, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    out = fps.join(by_fp, F.col("fp") == F.col("f"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one with the smallest id (then text digest).

    A null id is smaller than any other; a row repeated whole stays once. All columns stay as they were.
    """
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    d = near_duplicates(keyed, shingle, radius, "key", "text")
    d = d.groupBy("key", "component_id").agg(F.count(F.lit(1)).alias("n"))
    d = d.select("key", F.col("key").eqNullSafe(F.col("component_id")).alias("keep"), "n")
    return settle(docs, d.where("not keep or n > 1"), id_col, text_col)
