"""Best-fit packing into bins of several permitted lengths.

Long texts are cut into pieces of the largest capacity; no token is dropped. Pieces are dealt evenly to
shards by a hash, and each shard is packed on its own by best fit decreasing: a piece goes to the open
bin it fits most tightly; if it fits none, the capacity with the least cost per token it can expect to
hold is opened, given how many tokens of smaller pieces are still to come. At the end every bin is
downsized to the smallest permitted capacity that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import BLANKS, cut, text_or_empty

CAPACITIES = (512, 1024, 2048, 4096)
# Cost of a bin: its length, plus what a sequence costs however short, plus attention's quadratic part.
BIN_COST, QUADRATIC = 32.0, 1 / 65536
# Pieces per shard, on average: the packing is as good as one over all rows, and one shard is one small task.
SHARD_PIECES = 20_000


def n_tokens(text: str) -> Column:
    """Words of a text plus one end token (null text: just the end)."""
    t = F.regexp_replace(text_or_empty(text), "^" + BLANKS, "")
    t = F.regexp_replace(t, BLANKS + "$", "")
    return F.when(t == "", 1).otherwise(F.size(F.split(t, BLANKS)) + 1).cast("long")


def cost(capacity: int) -> float:
    return BIN_COST + capacity + QUADRATIC * capacity * capacity


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, offset in it, capacity of each bin). Lengths must be in decreasing order."""
    caps = sorted(capacities)
    rest: list[tuple[int, int]] = []  # (free tokens, bin) of open bins, sorted
    used: list[int] = []
    bins, offsets = [], []
    to_come = sum(lengths)
    for n in lengths:
        to_come -= n
        k = bisect_left(rest, (n, -1))
        if k < len(rest):
            free, b = rest.pop(k)
        else:
            # What a larger bin has left can be filled only by what is still to come.
            size = min((c for c in caps if c >= n), key=lambda c: (cost(c) / (n + min(c - n, to_come)), c))
            free, b = size, len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if free > n:
            insort(rest, (free - n, b))
    return bins, offsets, [next(c for c in caps if c >= u) for u in used]


def pack_documents(docs: DataFrame, length: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                   capacities: tuple[int, ...] = CAPACITIES, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: (id, row, piece, start, n_tokens, bin_id, bin_offset, capacity).

    ``row`` tells repeated rows (equal id and length) apart; ``start`` is the piece's first token in its
    text. Null or empty texts are one end token. Null ids are packed like any other; an empty table
    gives no rows. Bins are numbered ``shard:bin``.
    """
    top = max(capacities)
    n = n_tokens(text_col) if length is None else length
    rows = docs.select(F.col(id_col).alias("id"), n.alias("n")).groupBy("id", "n").agg(F.count(F.lit(1)).alias("m"))
    rows = rows.select("id", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("row"))
    pieces = rows.select("id", "row", "n", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(top).cast("long"))).alias("piece", "start"))
    pieces = cut(pieces.select("id", "row", F.col("piece").cast("long"), "start",
                               F.least(F.col("n") - F.col("start"), F.lit(top)).cast("long").alias("n_tokens")))
    shards = max(1, -(-pieces.count() // shard_pieces))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("id", "row", "piece"), F.lit(shards)))
    kind = pieces.schema["id"].dataType.simpleString()

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "id", "row", "piece"], ascending=[False, True, True, True], kind="stable")
        bins, offsets, caps = pack(pdf["n_tokens"].tolist(), capacities)
        names = pdf["shard"].astype(str) + ":" + pd.Series(bins, index=pdf.index).astype(str)
        return pdf.assign(bin_id=names, bin_offset=np.array(offsets, np.int64),
                          capacity=np.array(caps, np.int64)[bins]).drop(columns=["shard"])

    out = pieces.groupBy("shard").applyInPandas(
        one, f"id {kind}, row long, piece long, start long, n_tokens long, bin_id string, bin_offset long, capacity long")
    return out.withColumnRenamed("id", id_col)
