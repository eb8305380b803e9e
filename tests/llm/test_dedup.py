"""Exact dedup, SimHash near-dedup and repeated passages against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from postmill.llm import blocks, exact_dedup, simhash, suffix_dedup
from tests.llm.helpers import empty, lower, rows, table, words


def order(i):
    return -1 if i is None else i


def test_exact_dedup_equals_brute_force(spark):
    data = rows()
    got = Counter(tuple(r) for r in exact_dedup.exact_dedup(table(spark, data), digest_all=True).collect())
    groups = defaultdict(list)
    for i, t in data:
        groups[lower(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        best = max(ids, key=order)
        for k, i in enumerate(sorted(ids, key=order)):
            want[(i, best, len(ids), k == len(ids) - 1, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert got == want


def test_exact_dedup_hashes_only_survivors(spark):
    d = exact_dedup.exact_dedup(table(spark, [(1, "alone"), (2, "twice"), (3, "TWICE")])).collect()
    assert {r.doc_id: r.digest is None for r in d} == {1: True, 2: False, 3: False}


def test_keep_distinct_keeps_columns_and_one_row_each(spark):
    data = rows()
    kept = exact_dedup.keep_distinct(table(spark, data))
    assert kept.columns == table(spark, []).columns
    got = kept.collect()
    assert Counter(lower(r.text) for r in got) == {lower(t): 1 for _, t in data}
    best = {}
    for i, t in data:
        best[lower(t)] = max(best.get(lower(t), -1), order(i))
    assert all(order(r.doc_id) == best[lower(r.text)] for r in got)


def test_empty_tables(spark):
    e = empty(spark)
    for out in (exact_dedup.exact_dedup(e), exact_dedup.keep_distinct(e), simhash.near_duplicates(e),
                simhash.keep_representatives(e), suffix_dedup.strip_repeats(e)):
        assert out.count() == 0


def fingerprint(t, n):
    w = words(t)
    s = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def near_brute_force(data):
    f = np.array([fingerprint(t, 4) for _, t in data], np.uint64)
    linked = np.bitwise_count(f[:, None] ^ f[None, :]) <= 4
    label = np.arange(len(f))
    while True:
        new = np.array([label[linked[i]].min() for i in range(len(f))])
        if (new == label).all():
            break
        label = new
    least = defaultdict(lambda: None)
    for (i, _), g in zip(data, label):
        if i is not None:
            least[g] = i if least[g] is None else min(least[g], i)
    return Counter((i, f"{x:016x}", least[g]) for (i, _), x, g in zip(data, f, label)), label


@pytest.mark.parametrize("piece", [4096, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, piece):
    """Also with buckets dealt out in pieces of three rows."""
    monkeypatch.setattr(simhash, "PIECE", piece)
    monkeypatch.setattr(simhash, "TASK_ROWS", 500)
    data = rows()
    base = words(data[140 - 140 + 30][1]) * 8
    data += [(1000 + k, " ".join(base[:-k] + ["edit"] * k)) for k in range(1, 30)]
    got = Counter(tuple(r) for r in simhash.near_duplicates(table(spark, data)).collect())
    assert got == near_brute_force(data)[0]


def test_within_equals_popcount():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2 ** 63, 70_000, dtype=np.uint64) & rng.integers(0, 2 ** 63, 70_000, dtype=np.uint64)
    x[::3] &= rng.integers(0, 2 ** 63, len(x[::3]), dtype=np.uint64) & np.uint64(0x0F0F00000000FFFF)
    x[::7] &= np.uint64(0xF0000000000000FF)
    for radius in (0, 1, 4, 7):
        assert (simhash.within(x, radius) == (np.bitwise_count(x) <= radius)).all()


def test_representatives(spark):
    data = rows()
    got = simhash.keep_representatives(table(spark, data)).collect()
    label = near_brute_force(data)[1]
    assert len(got) == len(set(label.tolist()))
    groups = defaultdict(list)
    for (i, t), g in zip(data, label):
        groups[g].append((order(i), hashlib.sha256((t or "").encode()).hexdigest()))
    assert Counter((order(r.doc_id), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got) == Counter(
        min(v) for v in groups.values())


def passages_brute_force(data, length):
    """(id, n_bytes, spans, kept) per row; ids decide, a null id is the largest."""
    first = {}
    for i, t in data:
        b, own = (t or "").encode(), float("inf") if i is None else i
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            first[w] = min(first.get(w, float("inf")), own)
    out = []
    for i, t in data:
        b, own = (t or "").encode(), float("inf") if i is None else i
        covered = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < own:
                covered[s:s + length] = True
        edge = np.flatnonzero(np.diff(np.r_[0, covered.astype(int), 0]))
        out.append((i, len(b), tuple(zip(edge[::2].tolist(), edge[1::2].tolist())),
                    bytes(np.frombuffer(b, np.uint8)[~covered])))
    return Counter(out)


@pytest.mark.parametrize("hot,block,length", [(20_000, 8 << 20, 50), (2, 3000, 50), (20_000, 3000, 37)])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, hot, block, length):
    """Also with every shared bucket refined by window, with many blocks and parts, and another length."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "PIECE", 2000)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 40_000)
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(blocks, "PART_KEYS", 3000)
    data = rows() + [(200, "a" * 300), (201, "a" * 70), (202, "ab" * 60), (203, "é" * 80), (204, "xé" + "é" * 60), (205, "a" * 49)]
    got = suffix_dedup.strip_repeats(table(spark, data), length=length).collect()
    assert Counter((r.doc_id, r.n_bytes, tuple((s.s, s.e) for s in r.spans), bytes(r.kept)) for r in got) == passages_brute_force(data, length)
