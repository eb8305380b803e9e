"""Language-model scoring: bigrams by deleted interpolation.

``P(w | v) = l2[b] c(v,w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1)``: maximum-likelihood estimates of
the training documents, mixed with weights that depend on the bucket b of the context's frequency
c(v). The weights are learned by expectation-maximisation on held-out counts: one fold of the training
documents is deleted from the counts and its tokens are predicted from the rest. The first token's
context is the end token.

Counts come from an exchange of distinct words and bigrams per text block (``blocks``). EM depends on a
token only through its bucket and the two ratios of its estimates to the uniform one, so the
held-out tokens are summed up in a table of those, on a fine logarithmic grid of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm import blocks as B

FOLDS, HELD_OUT, DELETED = 5, 1, 2
SEED = 42
# Larger blocks and parts than elsewhere: a block repeats more of its words and bigrams the larger it is.
BLOCK_BYTES, PART_KEYS = 8 << 20, 2_000_000
# Context-frequency buckets: 0, 1, 2-3, 4-7, ... occurrences.
BUCKETS = 48
# Ratios are rounded to a quarter of an octave, within 64 octaves either side.
STEPS, RANGE = 4, 64
ROUNDS, SETTLED = 200, 1e-7

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def fold(ids: np.ndarray) -> np.ndarray:
    """crc32 of the id as text, modulo the folds; null ids are in fold -1, which is trained on."""
    from zlib import crc32

    return np.array([-1 if i == B.NO_ID else crc32(str(i).encode()) % FOLDS for i in ids.tolist()], np.int64)


@dataclass
class Tokens:
    """Tokens of a block: the sorted hashes of its words, each token's place among them, where each document's tokens begin,
    and the document of each token."""
    ids: np.ndarray
    words: np.ndarray
    at: np.ndarray
    begin: np.ndarray
    doc: np.ndarray

    @property
    def bigram(self) -> np.ndarray:
        """Hash of (previous token, token); a document's first token follows an end token."""
        first, second = self.words * _MIX[0], self.words ^ _MIX[1]
        before = np.r_[np.uint64(0), first[self.at[:-1]]]
        before[self.begin] = np.uint64(END) * _MIX[0]
        x = before + second[self.at]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


# The end token's hash: that of a string no word can be.
END = 0x2545F4914F6CDD1D


def numbered(z: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """A block of texts as numbered tokens: ``u`` the sorted hashes of its words (A-Z lower-cased) and the end token,
    ``w`` the place in it of each token, ``n`` the tokens of each document. Done once; later passes only index."""
    from xxhash import xxh64_intdigest

    text, at = _FOLD[z["text"]].tobytes(), z["at"].tolist()
    known: dict[bytes, int] = {}
    local, sizes = [], []
    for s, e in zip(at, at[1:]):
        # bytes.split() parts at exactly the six blanks of the word rule.
        words = text[s:e].split()
        local += [known.setdefault(w, len(known)) for w in words]
        local.append(-1)
        sizes.append(len(words) + 1)
    hashes = np.r_[np.fromiter((xxh64_intdigest(w, SEED) for w in known), np.uint64, len(known)), np.uint64(END)]
    u, place = np.unique(hashes, return_inverse=True)
    return {"ids": z["ids"], "u": u, "w": place[np.array(local, np.int64)].astype(np.int32), "n": np.array(sizes, np.int64)}


def tokens(payload: bytes) -> Tokens:
    z = B.thawed(payload)
    n = z["n"]
    return Tokens(z["ids"], z["u"], z["w"], np.cumsum(n) - n, np.repeat(np.arange(len(n)), n))


def _ask(n_parts: int):
    def ask(row):
        t = tokens(row["payload"])
        f = fold(t.ids)[t.doc]
        trained, deleted = f != HELD_OUT, f == DELETED
        bigrams, b = np.unique(t.bigram, return_inverse=True)
        both = [(k, *(np.bincount(at, of, len(k)).astype(np.uint32) for of in (trained, deleted))) for k, at in ((t.words, t.at), (bigrams, b))]
        cuts = [B.cut_by_part(k, n_parts) for k, _, _ in both]
        for p in range(n_parts):
            piece = {}
            for name, (k, n, d), c in zip("ub", both, cuts):
                s = slice(c[p], c[p + 1])
                piece |= {f"{name}k": k[s], f"{name}n": n[s], f"{name}d": d[s]}
            yield p, piece

    return ask


def _combine(pieces: list[dict]):
    """Counts of every key over all blocks, handed back per block; in all, the distinct trained words."""
    answers, types = [{} for _ in pieces], 0
    for name in "ub":
        keys = np.concatenate([p[f"{name}k"] for p in pieces])
        ends = np.cumsum([len(p[f"{name}k"]) for p in pieces])
        u, inverse = np.unique(keys, return_inverse=True)
        del keys
        for col in "nd":
            n = np.bincount(inverse, np.concatenate([p[name + col] for p in pieces]), len(u)).astype(np.int64)
            if name == "u" and col == "n":
                types = int((n > 0).sum())
            for a, x in zip(answers, np.split(n[inverse], ends[:-1])):
                a[name + col] = x
    return answers, types


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0), BUCKETS - 1).astype(np.int64)


def _context(t: Tokens, per_token: np.ndarray, end: int) -> np.ndarray:
    c = np.r_[end, per_token[:-1]]
    c[t.begin] = end
    return c


def _ratio(x: np.ndarray) -> np.ndarray:
    """log2 on the grid; zero estimates fall below it."""
    with np.errstate(divide="ignore"):
        return np.clip(np.round(np.log2(x) * STEPS), -RANGE * STEPS, RANGE * STEPS).astype(np.int64)


def learn_weights(cells: pd.DataFrame) -> np.ndarray:
    """(bucket, 3) weights of bigram, unigram and uniform, by EM over cells (b, r2, r1, n).

    Buckets without held-out tokens take the weights of the next lower one; contexts never seen have
    no bigram estimate.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0.0, 0.5, 0.5)
    for b in range(BUCKETS):
        x = cells[cells["b"] == b]
        if not len(x):
            if b > 1:
                weights[b] = weights[b - 1]
            continue
        low = -RANGE * STEPS
        p = np.column_stack([np.where(x[c] <= low, 0.0, 2.0 ** (x[c].to_numpy() / STEPS)) for c in ("r2", "r1")] + [np.ones(len(x))])
        n, w = x["n"].to_numpy(float), weights[b].copy()
        for _ in range(ROUNDS):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            new = np.maximum((share * n[:, None]).sum(axis=0) / n.sum(), 1e-9)
            new /= new.sum()
            done = np.abs(new - w).max() < SETTLED
            w = new
            if done:
                break
        weights[b] = w
    weights[0, 0] = 0.0
    weights[0] /= weights[0].sum()
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Documents whose crc32(id as text) mod 5 is 1 are held out of all counts. ``base_score`` is the
    add-one-half unigram log10 probability, ``score`` the interpolated bigram model's. Null text
    counts as empty (one end token); rows with a null id are trained on; repeated rows count as often
    as they occur; without training tokens every estimate but the uniform one is zero.
    """
    source = B.write(docs, id_col, text_col, BLOCK_BYTES, numbered)
    # Distinct keys per block are fewer than its tokens, and a token takes five bytes or more.
    n_parts = B.parts_for(source.n_bytes / 6 * 0.9, PART_KEYS)
    counts = B.exchange(source, _ask(n_parts), _combine, n_parts)
    types = int(counts.agg(F.sum("total")).first()[0] or 0)
    sizes = source.table.mapInPandas(_sizes, "trained long, deleted long, trained_docs long, deleted_docs long").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("trained", "deleted", "trained_docs", "deleted_docs")]).first()
    total, ends = sizes["trained"], sizes["trained_docs"]
    kept, kept_ends = total - sizes["deleted"], ends - sizes["deleted_docs"]

    def estimates(c: np.ndarray, u: np.ndarray, b: np.ndarray, n: int):
        """(context counts, bigram and unigram estimates) of tokens."""
        return c, b / np.maximum(c, 1), u / max(n, 1)

    def heldout(batches):
        for pdf in batches:
            for payload, answer in zip(pdf["payload"], pdf["a0"]):
                t = tokens(payload)
                held = (fold(t.ids) == DELETED)[t.doc]
                if not held.any():
                    continue
                bigrams = t.bigram
                b = np.searchsorted(np.unique(bigrams), bigrams[held])
                n = {k: B.joined(answer, k, np.int64) for k in ("un", "ud", "bn", "bd")}
                u = (n["un"] - n["ud"])[t.at]
                c, p2, p1 = estimates(_context(t, u, kept_ends)[held], u[held], (n["bn"] - n["bd"])[b], kept)
                cells = pd.DataFrame({"b": _bucket(c), "r2": _ratio(p2 * (types + 1)), "r1": _ratio(p1 * (types + 1))})
                yield cells.groupby(["b", "r2", "r1"]).size().rename("n").reset_index()
        B.give_back()

    both = B.answered(source, counts)
    cells = both.mapInPandas(heldout, "b long, r2 long, r1 long, n long").groupBy("b", "r2", "r1").agg(F.sum("n").alias("n"))
    weights = learn_weights(cells.toPandas().sort_values(["b", "r2", "r1"]))

    def scored(batches):
        for pdf in batches:
            for payload, answer in zip(pdf["payload"], pdf["a0"]):
                t = tokens(payload)
                u = B.joined(answer, "un", np.int64)[t.at]
                b = B.joined(answer, "bn", np.int64)[np.unique(t.bigram, return_inverse=True)[1]]
                c, p2, p1 = estimates(_context(t, u, ends), u, b, total)
                w = weights[_bucket(c)]
                p = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (types + 1))
                base = np.log10((u + 0.5) / (total + 0.5 * (types + 1)))
                sums = [np.add.reduceat(x, t.begin) for x in (np.ones(len(u), np.int64), (u > 0).astype(np.int64), base, p)]
                yield pd.DataFrame({"id": _nullable(t.ids),
                                    "held_out": fold(t.ids) == HELD_OUT, "n_tokens": sums[0], "n_known": sums[1],
                                    "train_tokens": np.int64(total), "base_score": sums[2], "score": sums[3]})
        B.give_back()

    out = both.mapInPandas(scored, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                   "base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def _nullable(ids: np.ndarray) -> pd.Series:
    out = pd.Series(ids, dtype="Int64")
    out[ids == B.NO_ID] = pd.NA
    return out


def _sizes(batches):
    """Tokens and documents of a block in training and in the deleted fold."""
    for pdf in batches:
        for payload in pdf["payload"]:
            z = B.thawed(payload)
            n, f = z["n"], fold(z["ids"])
            yield pd.DataFrame([(n[f != HELD_OUT].sum(), n[f == DELETED].sum(), (f != HELD_OUT).sum(), (f == DELETED).sum())],
                               columns=["trained", "deleted", "trained_docs", "deleted_docs"])
