"""Incremental ingestion of landed listing pages with Structured Streaming.

New JSON page files in a landing folder are read with an explicit schema. Duplicates are suppressed twice:

* A state store holds the keys seen lately. Of a micro-batch's rows of a key, the first arrival goes on if the key is
  not in state. Entries expire ``STATE_HOURS`` after their key came in. The watermark is on the time of processing: one
  on fetch or creation time would drop pages that land late with all their new posts, and nothing may be lost here.
* What goes on meets the key index beside the store (``sources/keyindex``), which knows all older keys and reads only
  the buckets that may hold one of the batch. The store itself is not read.

A micro-batch writes its posts, then its keys, between two marks. If a mark is missing after a failure, the
batch that comes again is compared with the store once, so nothing is added twice or lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill import schema as S
from postmill.session import checkpoint_dir, scratch_path
from postmill.sources import listing as LS
from postmill.sources import store as ST
from postmill.sources.keyindex import KeyIndex

STATE_HOURS = 48
_ORDER = ("_fetched", "_listing", "_page", "_position")


def init_store(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], S.POSTS).write.mode("ignore").partitionBy("subreddit").parquet(path)


def land(pages: DataFrame, landing: str) -> None:
    """Write listing pages as JSON files into the landing folder (one run = new files)."""
    pages.write.mode("append").json(landing)


def index_path(store: str) -> str:
    return store.rstrip("/") + "_index"


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per key the row that comes first in ``_ORDER``, nulls first. A key's rows are in one task, which holds its keys' first rows."""
    held: list = []
    waiting = kept = 0

    def merged(parts):
        keys = pa.Table.from_batches([b.select(["post_id", *_ORDER]) for b in parts]).combine_chunks()
        order = pc.sort_indices(keys, sort_keys=[(c, "ascending") for c in keys.column_names], null_placement="at_start")
        ids = keys["post_id"].take(order).combine_chunks()
        first = np.ones(len(ids), bool)
        first[1:] = pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
        chosen = np.zeros(len(ids), bool)
        chosen[order.to_numpy()[first]] = True
        ends = np.cumsum([b.num_rows for b in parts])
        return [b.filter(pa.array(chosen[end - b.num_rows:end])) for b, end in zip(parts, ends, strict=True)]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            waiting += batch.num_rows
            if waiting > max(kept, 10_000):
                held = [b for b in merged(held) if b.num_rows]
                waiting, kept = 0, sum(b.num_rows for b in held)
    yield from merged(held) if held else ()


def first_arrivals(rows: DataFrame, hours: float = STATE_HOURS) -> DataFrame:
    """Streaming rows with an ``arrival`` struct -> per key its first arrival, unless its key is in state."""
    names = S.POSTS.fieldNames()
    flat = rows.select(*names, F.col("arrival.fetched_at").alias("_fetched"), F.col("arrival.listing").alias("_listing"),
                       F.col("arrival.page").alias("_page"), F.col("arrival.position").alias("_position"))
    firsts = flat.repartition("post_id").mapInArrow(_firsts, flat.schema).select(*names, F.current_timestamp().alias("_seen"))
    # All rows of a micro-batch carry its time. An entry goes when the watermark, which lags by the delay, is past its time and the delay.
    return firsts.withWatermark("_seen", f"{round(hours * 1800)} seconds").dropDuplicatesWithinWatermark(["post_id"]).select(*names)


def _mark(spark: SparkSession, store: str, checkpoint: str, epoch: int, done: bool) -> None:
    (spark.createDataFrame([(checkpoint, epoch, done)], "checkpoint string, epoch bigint, done boolean").coalesce(1)
     .write.mode("overwrite").parquet(f"{index_path(store)}/mark"))


def _finished(spark: SparkSession, store: str) -> bool:
    """Whether the last micro-batch came to its end, so that the index holds all keys of the store."""
    try:
        r = spark.read.parquet(f"{index_path(store)}/mark").first()
    except AnalysisException:
        return False
    return bool(r and r["done"])


def start(spark: SparkSession, landing: str, store: str, checkpoint: str, available_now: bool = True,
          max_files: int | None = None, added: list | None = None):
    """Start the ingestion query; returns the StreamingQuery. ``added`` receives the rows that each micro-batch adds."""
    init_store(spark, store)
    checkpoint_dir(spark)
    reader = spark.readStream.schema(S.LANDED_LISTING)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = first_arrivals(ST.valid(LS.to_posts(reader.json(landing))))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # Read once, so that the state is updated once; and read by the caller's session, as the stream's has no adaptive execution.
        path = scratch_path(spark, "batch")
        batch.write.parquet(path)
        batch = spark.read.schema(batch.schema).parquet(path)
        if batch.isEmpty():
            # Only the state's clock has moved. An index that is not finished waits for the next rows.
            if added is not None:
                added.append(0)
            return
        index = KeyIndex(spark, index_path(store))
        finished = _finished(spark, store)
        if not finished:
            # The first batch over a store, or the one after a failure: the index is made anew from the store.
            index.build(ST.read_posts(spark, store).select("post_id"))
        _mark(spark, store, checkpoint, epoch_id, False)
        new = index.unseen(batch)
        keys = new.select("post_id").checkpoint(eager=True)
        rows = keys.count()
        if rows:
            ST.write_posts(new.select(*S.POSTS.fieldNames()), store)
            index.add(keys)
        _mark(spark, store, checkpoint, epoch_id, True)
        if added is not None:
            added.append(rows)

    w = rows.writeStream.outputMode("append").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def run_once(spark: SparkSession, landing: str, store: str, checkpoint: str) -> dict:
    """Process everything landed so far, then stop (a scheduled incremental run).

    Returns the run's counters, taken from the query itself: micro-batches, pages read, posts added, keys in state.
    """
    added: list = []
    q = start(spark, landing, store, checkpoint, available_now=True, added=added)
    q.awaitTermination()
    progress = [p for p in q.recentProgress if p["numInputRows"]]
    state = [s["numRowsTotal"] for p in progress[-1:] for s in p["stateOperators"]]
    return {"batches": len(added), "pages": sum(p["numInputRows"] for p in progress), "added": sum(added), "state": sum(state)}
