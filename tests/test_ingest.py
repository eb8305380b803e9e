"""Listing ingestion: envelope unwrap, keep-first dedup, insert-or-ignore, streaming."""

import json

from pyspark.sql import functions as F

from postmill import schema as S
from postmill.session import scratch_path
from postmill.sources import listing as LS
from postmill.sources import store as ST
from postmill.streaming import ingest as IG


def page(listing, pg, fetched, children):
    return json.dumps({"listing": listing, "page": pg, "fetched_at": fetched,
                       "data": {"after": None, "children": children}})


def child(pid, score, kind="t3", sub="python"):
    return {"kind": kind, "data": {"id": pid, "subreddit": sub, "title": f"t{pid}", "score": score,
                                   "created_utc": 1700000000.5, "is_self": True}}


def pages_df(spark, docs):
    return spark.read.schema(S.LANDED_LISTING).json(spark.sparkContext.parallelize(docs))


def test_unwrap_keeps_only_posts_and_defaults(spark):
    df = pages_df(spark, [page("python/hot", 0, "2024-06-01T00:00:00Z",
                               [child("a", 1), child("c1", 5, kind="t1"), child("", 3)])])
    rows = LS.to_posts(df).collect()
    assert sorted(r["post_id"] for r in rows) == ["", "a"]
    a = [r for r in rows if r["post_id"] == "a"][0]
    assert a["author"] == "[deleted]" and a["url"] == "" and a["permalink"] == "https://www.reddit.com"
    assert a["num_comments"] == 0 and a["over_18"] is False and a["selftext"] == ""
    assert str(a["created_utc"]) == "2023-11-14 22:13:20.500000"


def test_missing_envelope_yields_no_rows(spark):
    df = pages_df(spark, [json.dumps({"listing": "x", "page": 0, "fetched_at": "2024-06-01T00:00:00Z"})])
    assert LS.to_posts(df).count() == 0


def test_insert_or_ignore_first_wins(spark):
    store = spark.createDataFrame([], S.POSTS)
    run1 = pages_df(spark, [page("python/hot", 0, "2024-06-01T00:00:00Z", [child("a", 1), child("a", 7)])])
    run2 = pages_df(spark, [page("python/new", 0, "2024-06-02T00:00:00Z", [child("a", 99), child("b", 2)])])
    store = ST.append(store, LS.to_posts(run1))
    store = ST.append(store, LS.to_posts(run2))
    got = {r["post_id"]: r["score"] for r in store.collect()}
    assert got == {"a": 1, "b": 2}


def test_stream_one_or_many_batches_same_table(spark):
    docs = [page("python/hot", i, f"2024-06-0{1 + i}T00:00:00Z", [child("a", 10 + i), child(f"x{i}", i)])
            for i in range(3)]
    results = []
    for split in (False, True):
        base = scratch_path(spark, "test-stream")
        landing, store, ckpt = f"{base}/landing", f"{base}/posts", f"{base}/ckpt"
        batches = [[d] for d in docs] if split else [docs]
        for b in batches:
            IG.land(spark.createDataFrame([(d,) for d in b], "value string").select(
                F.from_json("value", S.LANDED_LISTING).alias("j")).select("j.*"), landing)
            IG.run_once(spark, landing, store, ckpt)
        results.append(sorted((r["post_id"], r["score"]) for r in spark.read.parquet(store).collect()))
    assert results[0] == results[1] == [("a", 10), ("x0", 0), ("x1", 1), ("x2", 2)]


def test_listing_cap(spark):
    rows = spark.createDataFrame([("l1", i) for i in range(5)] + [("l2", 0)], "listing string, arrival int")
    kept = ST.cap_per_listing(rows, ceiling=3)
    assert sorted((r["listing"], r["arrival"]) for r in kept.collect()) == [("l1", 0), ("l1", 1), ("l1", 2), ("l2", 0)]


def test_write_back_keeps_unmatched(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "post_id string, cluster_id int, kw string")
    upd = spark.createDataFrame([("a", 5)], "post_id string, cluster_id int")
    got = {r["post_id"]: (r["cluster_id"], r["kw"]) for r in ST.write_back(base, upd).collect()}
    assert got == {"a": (5, "x"), "b": (2, "y")}


def test_evolve_defaults(spark):
    a = spark.createDataFrame([("a", "k1")], "post_id string, keywords string")
    b = spark.createDataFrame([("b",)], "post_id string")
    got = {r["post_id"]: r["keywords"] for r in ST.evolve([a, b], {"keywords": ""}).collect()}
    assert got == {"a": "k1", "b": ""}


def test_store_layout_prunes_by_source(spark):
    from postmill.sources import tables as TB
    from conftest import SF_SMALL
    path = scratch_path(spark, "test-store") + "/posts"
    ST.write_posts(TB.stored_posts(spark, SF_SMALL), path)
    back = spark.read.parquet(path)
    assert back.count() == 200
    q = back.where(F.col("subreddit") == "src1")
    assert "PartitionFilters: [isnotnull(subreddit" in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == TB.posts_view(spark, SF_SMALL).where(F.col("subreddit") == "src1").count()


def run_pages(spark, base, docs):
    IG.land(spark.createDataFrame([(d,) for d in docs], "value string").select(
        F.from_json("value", S.LANDED_LISTING).alias("j")).select("j.*"), f"{base}/landing")
    return IG.run_once(spark, f"{base}/landing", f"{base}/posts", f"{base}/ckpt")


def stored(spark, base):
    return sorted((r["post_id"], r["score"]) for r in ST.read_posts(spark, f"{base}/posts").collect())


def test_stream_state_late_pages_and_restart(spark, monkeypatch):
    base = scratch_path(spark, "test-state")
    first = run_pages(spark, base, [page("python/hot", 0, "2024-06-05T00:00:00Z", [child("a", 1), child("b", 2), child("a", 9)])])
    assert (first["added"], first["state"], first["pages"]) == (2, 2, 1)
    # A page that lands late: its known post is ignored, its new post is not lost.
    late = run_pages(spark, base, [page("python/new", 0, "2024-01-01T00:00:00Z", [child("a", 50), child("c", 3)])])
    assert (late["added"], late["state"]) == (1, 3)
    assert stored(spark, base) == [("a", 1), ("b", 2), ("c", 3)]
    # The keys are written, but not the closing mark: the batch that comes again adds nothing twice.
    mark = IG._mark
    monkeypatch.setattr(IG, "_mark", lambda sp, st, ck, e, done: 1 / 0 if done else mark(sp, st, ck, e, done))
    try:
        run_pages(spark, base, [page("python/new", 1, "2024-06-06T00:00:00Z", [child("d", 4), child("b", 60)])])
        raise AssertionError("the run should have failed")
    except Exception as e:  # noqa: BLE001
        assert "ZeroDivision" in str(e)
    monkeypatch.setattr(IG, "_mark", mark)
    assert IG.run_once(spark, f"{base}/landing", f"{base}/posts", f"{base}/ckpt")["added"] == 0
    assert stored(spark, base) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    # A query without the old state: the index knows the older keys.
    IG.land(spark.read.schema(S.LANDED_LISTING).json(f"{base}/landing"), f"{base}/again")
    again = IG.run_once(spark, f"{base}/again", f"{base}/posts", f"{base}/ckpt2")
    assert again["added"] == 0 and again["state"] == 4


def test_key_index_reads_only_buckets_that_may_collide(spark):
    from postmill.sources import keyindex as KI
    index = KI.KeyIndex(spark, scratch_path(spark, "test-index"))
    old = spark.range(2000).selectExpr("concat('k', id) as post_id")
    index.build(old)
    index.add(spark.createDataFrame([("late",)], "post_id string"))
    fresh = spark.range(300).selectExpr("concat('n', id) as post_id", "id as v")
    assert index.unseen(fresh).count() == 300 and len(index.read) <= 3
    some = spark.createDataFrame([("k7", 1), ("k7", 2), ("late", 3), ("new", 4)], "post_id string, v int")
    assert [tuple(r) for r in index.unseen(some).collect()] == [("new", 4)]
    assert len(index.read) == 2
    held = index._table(index.keys_path, "post_id string", index.read)
    assert {f.split("bucket=")[1].split("/")[0] for f in (r[0] for r in held.select(F.input_file_name()).distinct().collect())} == set(map(str, index.read))
    assert "PartitionFilters: [bucket" in held._jdf.queryExecution().executedPlan().toString().replace("isnotnull(bucket", "bucket")


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    from postmill.sources import keyindex as KI
    monkeypatch.setattr(KI, "BLOOM_BITS", 64)
    index = KI.KeyIndex(spark, scratch_path(spark, "test-full"))
    index.build(spark.range(3000).selectExpr("concat('k', id) as post_id"))
    batch = spark.range(2900, 3100).selectExpr("concat('k', id) as post_id")
    assert sorted(r[0] for r in index.unseen(batch).collect()) == sorted(f"k{i}" for i in range(3000, 3100))


def test_merge_rewrites_only_changed_partitions(spark):
    base = scratch_path(spark, "test-merge")
    path, staging = f"{base}/posts", f"{base}/staging"
    rows = [(f"p{i}", f"s{i % 4}" if i % 4 else None, i, "old") for i in range(40)]
    spark.createDataFrame(rows, "post_id string, sub string, cluster_id int, kw string").write.partitionBy("sub").parquet(path)

    def files():
        return {r["sub"]: {x["f"] for x in spark.read.parquet(path).select("sub", F.input_file_name().alias("f")).distinct().collect() if x["sub"] == r["sub"]}
                for r in spark.read.parquet(path).select("sub").distinct().collect()}

    before = files()
    update = spark.createDataFrame([("p1", 100, "new"), ("p2", 2, "old"), ("p3", None, None), ("none", 1, "x")], "post_id string, cluster_id int, kw string")
    assert ST.merge(spark, path, update, staging, "sub") == ["s1"]  # p2's values do not change, p3's are null
    after = files()
    assert {k for k in before if before[k] != after[k]} == {"s1"}
    want = {(i, s, 100 if i == "p1" else c, "new" if i == "p1" else k) for i, s, c, k in rows}

    def table():
        return {(r["post_id"], r["sub"], r["cluster_id"], r["kw"]) for r in spark.read.parquet(path).collect()}

    assert table() == want
    assert ST.merge(spark, path, spark.createDataFrame([("p4", 7)], "post_id string, cluster_id int"), staging, "sub") == [None]
    want = {(i, s, 7 if i == "p4" else c, k) for i, s, c, k in want}
    assert table() == want
    # A failure after staging: the next call puts the staged partitions in place first.
    staged = spark.read.parquet(path).where("sub = 's2'").withColumn("kw", F.lit("staged"))
    staged.write.mode("overwrite").partitionBy("sub").parquet(staging)
    assert ST.merge(spark, path, update.limit(0), staging, "sub") == []
    assert table() == {(i, s, c, "staged" if s == "s2" else k) for i, s, c, k in want}
    assert ST.resume(spark, path, staging, "sub") is False


def test_first_in_order_cuts_inside_a_range(spark):
    rows = spark.range(1000).selectExpr("id", "struct(id * 37 % 1000 as x) as arrival").repartition(9)
    for n in (0, 1, 250, 999, 1000, 5000):
        got = sorted(r["arrival"]["x"] for r in ST.first_in_order(rows, n).collect())
        assert got == list(range(min(n, 1000)))


def test_page_without_fetch_time_takes_the_present(spark):
    pages = pages_df(spark, [page("python/hot", 0, "2024-06-01T00:00:00Z", [child("a", 1)])]).drop("fetched_at")
    r = LS.to_posts(pages).select(F.col("fetched_at") > F.current_timestamp() - F.expr("interval 1 hour")).first()
    assert r[0] is True


def test_merge_computes_its_update_once(spark):
    base = scratch_path(spark, "once")
    spark.createDataFrame([("p1", "s1", 0), ("p2", "s2", 0)], "post_id string, sub string, cluster_id int").write.partitionBy("sub").parquet(f"{base}/t")
    seen = spark.sparkContext.accumulator(0)

    def label(x):
        seen.add(1)
        return 7

    update = spark.createDataFrame([("p1",), ("p2",)], "post_id string").withColumn("cluster_id", F.udf(label, "int")("post_id"))
    assert ST.merge(spark, f"{base}/t", update, f"{base}/staging", "sub") == ["s1", "s2"]
    assert seen.value == 2


def test_index_append_asks_the_index_with_stored_arrivals(spark, monkeypatch):
    from postmill.plans import catalog
    from postmill.sources.keyindex import KeyIndex
    asked, unseen = [], KeyIndex.unseen
    monkeypatch.setattr(KeyIndex, "unseen", lambda self, batch: asked.append(batch.inputFiles()) or unseen(self, batch))
    assert catalog.QUERIES["index_append"](spark, "/root/testdata/sf0.001").count() == 200
    assert len(asked) == 2 and all(files and all("/arrived-" in f for f in files) for files in asked)


def test_first_arrivals_of_a_task_equal_brute_force_and_no_key_is_a_python_call(spark, monkeypatch):
    import random

    import pyarrow as pa
    draw = random.Random(2)
    none = [None]
    rows = [{"post_id": f"p{draw.randrange(4000)}", "_fetched": draw.choice([*range(5), *none]), "_listing": draw.choice(["a", "é", "z", *none]),
             "_page": draw.choice([*range(9), *none]), "_position": n, "score": n} for n in range(30_000)]
    schema = pa.schema([("post_id", pa.string()), ("_fetched", pa.timestamp("us")), ("_listing", pa.string()), ("_page", pa.int64()), ("_position", pa.int32()), ("score", pa.int64())])

    def order(r):
        return tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in IG._ORDER)

    want = {}
    for r in rows:
        if r["post_id"] not in want or order(r) < order(want[r["post_id"]]):
            want[r["post_id"]] = r
    got = [x for b in IG._firsts(iter(pa.Table.from_pylist(rows, schema).to_batches(700))) for x in b["score"].to_pylist()]
    assert sorted(got) == sorted(r["score"] for r in want.values()) and not list(IG._firsts(iter(())))
    landing = scratch_path(spark, "test-plan")
    IG.land(pages_df(spark, [page("python/hot", 0, "2024-06-01T00:00:00Z", [child("a", 1)])]), landing)
    pages = spark.readStream.schema(S.LANDED_LISTING).json(landing)
    plan = IG.first_arrivals(ST.valid(LS.to_posts(pages)))._jdf.queryExecution().logical().toString()
    assert "DeduplicateWithinWatermark" in plan and "FlatMapGroupsInPandasWithState" not in plan


def test_first_arrival_over_many_pages_of_one_batch(spark):
    base = scratch_path(spark, "test-first")
    docs = [page("python/hot", i, f"2024-06-{1 + i:02d}T00:00:00Z", [child(f"x{k}", 100 * i + k) for k in range(i, 20)]) for i in reversed(range(6))]
    got = run_pages(spark, base, docs)
    # The batch without rows, in which only the state's clock moves, adds nothing.
    assert (got["added"], got["state"], got["pages"]) == (20, 20, 6) and got["batches"] >= 1
    assert stored(spark, base) == sorted((f"x{k}", k) for k in range(20))
