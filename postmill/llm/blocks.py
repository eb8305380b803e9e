"""Compressed text blocks and keyed exchanges between them.

Operators that relate every position of every text to the rest of the corpus would shuffle several
times the input if each position were a row. Here the texts are written once as compressed blocks
(``write``), in a table bucketed by block. An exchange sends, per block, the *distinct* keys it needs as
packed arrays to the part that owns their key range, combines them there over all blocks, and sends
one answer per key back. A key that fills the corpus is one entry per block, so no part is skewed by it;
the number of parts follows the number of keys. ``answered`` meets blocks and answers by block, without
moving the texts.
"""

from __future__ import annotations

import ctypes
import io
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.session import scratch_path

BLOCK_BYTES = 4 << 20
# Text bytes per bucket of the block table, on average.
BUCKET_BYTES = 32 << 20
# Keys that one part combines, on average.
PART_KEYS = 1_000_000
# The largest id stands for a null id.
NO_ID = np.iinfo(np.int64).max


def _frozen(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays of any lengths as one compressed buffer."""
    sink = io.BytesIO()
    np.savez(sink, **arrays)
    return pa.compress(sink.getvalue(), codec="zstd", asbytes=True) + len(sink.getvalue()).to_bytes(8, "little")


def thawed(data: bytes) -> dict[str, np.ndarray]:
    """The arrays of a block."""
    return _thawed(data)


def _thawed(data: bytes) -> dict[str, np.ndarray]:
    raw = pa.decompress(data[:-8], int.from_bytes(data[-8:], "little"), codec="zstd", asbytes=True)
    with np.load(io.BytesIO(raw)) as z:
        return {k: z[k] for k in z.files}


def one_by_one(batches):
    """Rows of Arrow batches as dicts, never more than one of a batch at a time as Python objects."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
        give_back()


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, and several share an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def read_block(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, bytes of all texts one after the other, where each text begins; its end closes the list)."""
    z = _thawed(payload)
    return z["ids"], z["text"], z["at"]


@dataclass
class Blocks:
    """The block table (block, payload, n_docs), its number of buckets and the bytes of text in it."""
    table: DataFrame
    n_buckets: int
    n_bytes: int


def write(docs: DataFrame, id_col: str, text_col: str, block_bytes: int | None = None,
          shape: Callable[[dict], dict] | None = None) -> Blocks:
    """Write the table of text blocks into the shared checkpoint folder, bucketed by block.

    A block is up to ``block_bytes`` (else ``BLOCK_BYTES``) of whole texts (one longer text is a block of its own). Null
    texts are empty, ids are longs, null ids the largest long. Blocks are numbered by the task that
    wrote them; once written, all later steps read the same blocks. ``shape`` turns a block's arrays (ids, text, at)
    into those to be kept; ``read_block`` reads blocks without it, ``thawed`` all.
    """
    spark, limit = docs.sparkSession, block_bytes or BLOCK_BYTES

    def gather(batches):
        from pyspark import TaskContext

        task, made, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def block():
            at = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(t) for t in texts], out=at[1:])
            data = {"ids": np.array(ids, np.int64), "text": np.frombuffer(b"".join(texts), np.uint8), "at": at}
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(task << 32) + made], pa.int64()), "payload": pa.array([_frozen(shape(data) if shape else data)], pa.large_binary()).cast(pa.binary()),
                "n_docs": pa.array([len(ids)], pa.int64())})

        for row in one_by_one(batches):
            ids.append(NO_ID if row["id"] is None else row["id"])
            texts.append(row["text"] or b"")
            size += len(texts[-1])
            if size >= limit:
                yield block()
                made, ids, texts, size = made + 1, [], [], 0
        if ids:
            yield block()

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    n_bytes = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, -(-n_bytes // BUCKET_BYTES))
    name = scratch_path(spark, "blocks")
    (d.mapInArrow(gather, "block long, payload binary, n_docs long").write.format("parquet").option("compression", "none")
     .bucketBy(n_buckets, "block").option("path", name).saveAsTable(table := "blocks_" + name.rsplit("-", 1)[1]))
    return Blocks(spark.table(table), n_buckets, n_bytes)


def parts_for(keys: float, part_keys: int | None = None) -> int:
    return max(1, int(-(-keys // (part_keys or PART_KEYS))))


def cut_by_part(keys: np.ndarray, n_parts: int) -> np.ndarray:
    """Where each part's keys begin in the sorted ``keys``: parts own equal ranges of the key space."""
    edges = (np.arange(1, n_parts, dtype=np.float64) * (2.0 ** 64 / n_parts)).astype(np.uint64)
    return np.r_[0, np.searchsorted(keys, edges), len(keys)]


def exchange(blocks: Blocks | DataFrame, ask: Callable, combine: Callable, n_parts: int) -> DataFrame:
    """(block, part, answer, total): what the parts answer to each block.

    ``ask(block row)`` yields (part, arrays) for one block; ``combine(list of arrays, one per block)``
    returns the answers (arrays, one per block, in the same order) and one number for the part.
    """
    def asked(batches):
        for row in one_by_one(batches):
            for part, arrays in ask(row):
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "block": pa.array([row["block"]], pa.int64()),
                    "piece": pa.array([_frozen(arrays)], pa.binary())})

    def combined(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        answers, total = combine([_thawed(p.as_py()) for p in group["piece"]])
        out = pa.table({"block": group["block"], "part": group["part"], "answer": pa.array([_frozen(a) for a in answers], pa.binary()),
                        "total": pa.array(np.r_[total, np.zeros(len(group) - 1)])})
        del answers
        give_back()
        return out

    source = blocks.table if isinstance(blocks, Blocks) else blocks
    pieces = source.mapInArrow(asked, "part int, block long, piece binary")
    pieces = pieces.repartition(n_parts, "part")
    out = pieces.groupBy("part").applyInArrow(combined, "block long, part int, answer binary, total double")
    path = scratch_path(source.sparkSession, "answers")
    out.write.option("compression", "none").parquet(path)
    return source.sparkSession.read.parquet(path)


def answered(blocks: Blocks, *answers: DataFrame) -> DataFrame:
    """Every block with its answers in order of parts: (block, payload, n_docs, a0, a1, ...: arrays of binary).

    Answers are dealt out as the block table is bucketed, so only they move.
    """
    out = blocks.table
    for k, a in enumerate(answers):
        mine = a.repartition(blocks.n_buckets, "block").groupBy("block").agg(
            F.array_sort(F.collect_list(F.struct("part", "answer"))).alias("x"))
        out = out.join(mine.select("block", F.transform("x", lambda x: x["answer"]).alias(f"a{k}")), "block", "left")
    return out


def joined(answers, name: str, dtype) -> np.ndarray:
    """One array of the answers of all parts, in key order."""
    found = [_thawed(a)[name] for a in ([] if answers is None else answers)]
    return np.concatenate(found) if found else np.empty(0, dtype)
