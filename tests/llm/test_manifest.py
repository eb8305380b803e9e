"""Merkle manifest against a plain tree built in Python, also with groups of several rounds."""

import random
from hashlib import sha256
from zlib import crc32

import pytest

from postmill.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx int, digest string"


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def encode(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(row, text):
    doc_id, _, lang, source, n = row
    return h([encode(doc_id), encode(source), encode(lang), encode(n), encode(text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][k:k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def path(tree, k):
    out = []
    for nodes in tree[:-1]:
        run = k - k % 3
        out.append((nodes[run:k], nodes[k + 1:run + 3]))
        k //= 3
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0], leaf(r, r[1]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = levels([x[1] for x in groups[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for k, (doc_id, d, r) in enumerate(groups[s]):
            p = path(trees[s], k) + path(top, g)
            text = r[1]
            if doc_id is not None and text is not None and crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = leaf(r, text)
            for left, right in p:
                now = h([*left, now, *right])
            out.append((doc_id, d, trees[s][-1][0], top[-1][0], h([x for left, right in p for x in left + right]), now, now == top[-1][0]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA)


def sample(n, seed=1):
    rng = random.Random(seed)
    sources = [None, "", "a", "é", "a\n", "Z", "hot", "hot", "hot"]
    ids = rng.sample(range(-(1 << 40), 1 << 40), n - n // 2) + list(range(-40, n // 2 - 40))
    return [(i, rng.choice([None, "", "a\nb", "plain", "\n\n", "x" * 50_000 if k < 3 else "é\n😀"]), rng.choice([None, "", "en"]),
             rng.choice(sources), rng.choice([None, 0, -5, 12])) for k, i in enumerate(ids)]


@pytest.mark.parametrize("levels_", [1, 2, 7])
def test_manifest_equals_brute_force(spark, monkeypatch, levels_):
    monkeypatch.setattr(merkle, "LEVELS", levels_)
    monkeypatch.setattr(merkle, "SPAN", 3 ** levels_)
    monkeypatch.setattr(merkle, "STRETCH", 2)
    rows = sample(150)
    # Repeated ids, repeated rows, ids of null, the ends of the range.
    rows += [rows[0]] * 5 + [(rows[1][0], "other", "en", rows[1][3], 1), (rows[1][0], "third", "en", rows[1][3], 1)]
    rows += [(None, "t\n", "en", "hot", 1), (None, "u", "en", "hot", 1), (None, None, None, None, None)]
    rows += [((1 << 63) - 1, "t", None, "hot", 1), (-(1 << 63), "t", None, "hot", 1)]
    got = [tuple(r) for r in merkle.manifest(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_manifest_of_one_group_or_row_and_of_none(spark):
    for rows in ([(1, "a\n", "en", "s", 1)], [(k, "a\n", "en", "s", 1) for k in range(4)], [(k, "a", "en", f"s{k:02}", 1) for k in range(11)]):
        got = [tuple(r) for r in merkle.manifest(frame(spark, rows)).collect()]
        assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert merkle.manifest(frame(spark, [])).count() == 0


def test_ranks_of_a_hot_group_are_dealt_out(spark):
    """The rows of one group are spread over keys of 64 ids, and the directory over its chunks."""
    ids = spark.range(200_000).selectExpr("'hot' as tree", "id * 3 as key", "1L as c")
    d = merkle.directory(ids)
    assert d.count() == -(-600_000 // 64)
    assert d.agg({"before": "max"}).first()[0] == 200_000 - d.selectExpr("max_by(bit_count(bits), word)").first()[0]
