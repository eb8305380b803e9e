"""The pipeline's stages and the registered queries on the small tables."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postmill.llm import catalog, language_id
from tests.llm.helpers import lower, table, words
from tests.llm.test_dedup import near_brute_force
from tests.llm.test_text import leaks

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op5_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op6_simhash_near_dedup": "doc_id fingerprint component_id",
    "op7_url_filter": "page_id host path rule verdict",
    "op9_lm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op10_language_id": "doc_id held_out lang_pred score",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_columns(spark, name):
    assert catalog.QUERIES[name](spark, SF).columns[:len(COLUMNS[name].split())] == COLUMNS[name].split()


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in catalog.QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in cur.description]
    got = catalog.QUERIES[name](spark, SF).select(*names)
    assert Counter(tuple(r) for r in got.collect()) == Counter(cur.fetchall())


def test_pipeline_stages(spark, tmp_path):
    docs = corpus_pipeline.read(spark, SF, "documents")
    items = [tuple(r) for r in corpus_pipeline.read(spark, SF, "benchmark").select("item_id", "text").collect()]
    columns, state = docs.columns, [(r.doc_id, r.text) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name == "best_fit_packing":
            tokens = Counter()
            for r in out.collect():
                tokens[r.doc_id] += r.n_tokens
            assert tokens == {i: len(words(t)) + 1 for i, t in state}
            break
        assert out.columns == columns
        kept = sorted((r.doc_id, r.text) for r in out.collect())
        if name == "language_id":
            scored = language_id.predict(docs, language_id.fit(docs)).where("not rejected")
            want = sorted((r.doc_id, r.text) for r in scored.collect())
            assert len(kept) > 0.95 * len(state)
        elif name == "exact_dedup":
            best = {}
            for i, t in state:
                best[lower(t)] = max(best.get(lower(t), -1), i)
            want = sorted((i, t) for i, t in state if best[lower(t)] == i)
        elif name == "simhash_near_dedup":
            component = {i: c for i, _, c in near_brute_force(state)[0]}
            want = sorted((i, t) for i, t in state if component[i] == i)
        else:
            bad = {i for i, _, _ in leaks(state, items)}
            want = sorted((i, t) for i, t in state if i not in bad)
            assert bad
        assert kept == want, name
        docs, state = out, kept


def test_pipeline_stands_awkward_rows(spark, tmp_path):
    """Nulls, repeated rows and further columns pass every stage; an empty table stays empty."""
    from tests.llm.helpers import rows
    data = [(i, t) for i, t in rows() if not t or len(t) < 50_000]
    for start, label in ((table(spark, data), "rows"), (table(spark, data).where("false"), "empty")):
        docs = start.withColumn("lang", F.lit("xx"))
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).write.parquet(str(tmp_path / label / name))
            docs = spark.read.parquet(str(tmp_path / label / name))
        assert (docs.count() > 0) == (label == "rows")
