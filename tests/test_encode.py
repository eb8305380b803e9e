"""The bundled encoder: equal to a loop over words, each distinct word hashed once."""

import hashlib

import numpy as np

from postmill.operators import encode as EC

TEXTS = ["The sea, the SEA; a b", "", "Straße straße 12 ab1cd été", "the" + " sea" * 50]


def by_loop(text, dim):
    out = np.zeros(dim, np.float32)
    for w in __import__("re").findall(r"[^\W\d_]{2,}", text.lower()):
        h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
        out[h % dim] += 1 if h >> 63 else -1
    return out / (np.linalg.norm(out) or 1)


def test_vectors_equal_a_loop_and_a_word_is_hashed_once(monkeypatch):
    want, real, seen = [by_loop(t, 16) for t in TEXTS], hashlib.blake2b, []
    monkeypatch.setattr(hashlib, "blake2b", lambda b, **k: seen.append(b) or real(b, **k))
    assert np.allclose(EC.hashing_encoder(16)()(TEXTS), want)
    assert len(seen) == len(set(seen)) == 6
    monkeypatch.setattr(EC, "HELD_WORDS", 0)
    assert np.allclose(EC.hashing_encoder(16)()(TEXTS), want)
