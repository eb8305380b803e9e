"""Tokenizer alignment against the tokenizers' own libraries and a plain count of links."""

import random
from bisect import bisect_right
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from postmill.llm import align
from tests.llm.helpers import empty, rows, table


@pytest.fixture(scope="module")
def files():
    return align.Files.read()


def texts():
    out = rows() + [(500 + k, t) for k, t in enumerate((
        "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "▁", " ", "  two  blanks ", "\n\n\n", "\t" * 3000, " " * 5000, "x" * 5000, "\x00\x01", "don't we'll I'VE",
        "中文字符 と 한국어 😀😀", "é é", "  　", "﻿bom", "1234567890 3.14", "ﬁ Ａ", "a\r\nb", "\U0010ffff", "ab" * 3000, "a" + " " * 200_000 + "b", "\n" * 100_000))]
    rng = random.Random(8)
    return out + [(600 + k, "".join(rng.choice("ab é中😀\n .'") for _ in range(rng.randint(1, 300)))) for k in range(30)]


def brute(data):
    t = Tokenizer.from_file(align.TOKENIZER_A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=align.TOKENIZER_B)
    alphabet = align.byte_alphabet()
    out, counts = [], Counter()
    for i, text in data:
        a, b, ga, linked = [], [], [], []
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            ta = [bytes(alphabet[c] for c in t.id_to_token(x)) for x in a]
            tb = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(ta) != b" " + text.encode() or b"".join(tb) != b" " + text.encode():
                a, b = [], []
            else:
                ends = [list(np.cumsum([len(x) for x in y])) for y in (ta, tb)]
                cuts = sorted(set(ends[0]) & set(ends[1]))
                at = [0, 0]
                for hi in cuts:
                    to = [bisect_right(es, hi) for es in ends]
                    ga.append([ids[s:e] for ids, s, e in zip((a, b), at, to)])
                    linked += [(x, y) for x in ga[-1][0] for y in ga[-1][1]]
                    at = to
        counts.update(set(linked))
        out.append((i, a, b, ga, linked))
    best = {}
    for (x, _), c in counts.items():
        best[x] = max(best.get(x, 0), c)
    for i, a, b, ga, linked in out:
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in ga)
        yield (i, len(a), len(b), len(ga), len(linked), sum(counts[p] == best[p[0]] for p in linked), sum(counts[p] for p in linked),
               sha256(s.encode()).hexdigest() if s else "", s)


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_brute_force(spark, monkeypatch, files, small):
    if small:  # several blocks, parts, groups of a part and levels of the tree, chunks inside documents
        for name, value in (("BLOCK_BYTES", 3000), ("LINKS", 50), ("PART_PAIRS", 700), ("GROUP_PAIRS", 200)):
            monkeypatch.setattr(align, name, value)
    data = texts()
    got = [tuple(r) for r in align.align_corpus(table(spark, data).repartition(3), files, groups=True).collect()]
    assert sorted(got, key=str) == sorted(brute(data), key=str)
    assert sum(r[1] == 0 for r in got) >= 5


def test_alignment_of_nothing(spark, files):
    assert align.align_corpus(empty(spark), files).count() == 0
    got = align.align_corpus(table(spark, [(1, None), (2, "")]), files).collect()
    assert [tuple(r) for r in sorted(got)] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("n", [0, 1, 2, 100, 50_000])
def test_perfect_hash_is_minimal_and_verified(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 40, n))
    h = align.Perfect.build(keys)
    assert sorted(h.find(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 40, 1000), keys)
    assert (align.Perfect.of(h.arrays()).find(others) == -1).all()
    bits = 8 * (h.bits.nbytes) / max(len(keys), 1)
    assert n < 1000 or bits < 5


def test_perfect_hash_lists_what_the_cascade_leaves(monkeypatch):
    monkeypatch.setattr(align, "CASCADE", 1)
    keys = np.arange(5000, dtype=np.int64) * 7
    h = align.Perfect.build(keys)
    assert len(h.rest) and sorted(h.find(keys).tolist()) == list(range(5000))
