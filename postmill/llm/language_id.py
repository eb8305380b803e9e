"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is its bytes, ASCII letters lower-cased and everything in ASCII that is no letter a blank;
subwords are its 2-, 3- and 4-grams, hashed into buckets. A document's vector is the mean embedding
of its subwords and a linear softmax over that gives the label (numpy SGD, on a bounded sample of
labelled rows). The softmax is calibrated by a temperature on the part of the sample kept out of the
fit, and the rejection threshold is a low quantile of the calibrated scores of correct answers there,
over whole texts, short pieces of them and pieces of two labels joined.
Prediction reads whole texts, in the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
DIM = 16
# Bound of the fit: at most so many labelled rows in all, spread evenly over the labels.
TRAIN_ROWS = 1600
EPOCHS = 12
RATE = 4.0
# Of the correct answers in the calibration part, so many may score below the threshold.
REJECT_QUANTILE = 0.005
# The calibration part also has pieces of its texts, of so many characters, and each joined to one of another label.
PIECE_CHARS = (24, 48, 96)
# Texts are hashed in pieces of so many bytes; the pieces overlap, so no subword is lost.
PIECE = 1 << 20
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123, dtype=np.uint8)


def subwords(text: str):
    """Bucket numbers of all subwords of ``text``, piece by piece; grams of blanks only are left out."""
    b = _FOLD[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    for lo in range(0, max(len(b) - 1, 1), PIECE):
        x = b[lo:lo + PIECE + 3].astype(np.uint32)
        own = min(PIECE, len(b) - lo)
        g = x[:-1] << 8 | x[1:]
        for n in (2, 3, 4):
            if n > 2:
                g = g[:-1] << 8 | x[n - 1:]
            h = (g ^ np.uint32(n * 0x5BD1E995 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            keep = g[:own] & np.uint32(0xFFFF) != 0x2020
            yield (h[:own][keep] >> np.uint32(32 - 14)).astype(np.int64)


def counts(text: str) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for idx in subwords(text):
        total += np.bincount(idx, minlength=BUCKETS)
    return total


def pieces(text: str) -> list[np.ndarray]:
    """Subword counts of the piece of each length in the middle of a longer text, without cut words."""
    out = []
    for n in PIECE_CHARS:
        at = (len(text) - n) // 2
        x = text[at:at + n] if at >= 0 else ""
        words = x.split(" ")
        out.append(counts(" ".join(words[1:-1]) if len(words) > 3 else x))
    return out


@dataclass
class LanguageModel:
    """``scores``: label weights by bucket (embedding times output layer); mean over subwords gives logits."""
    labels: list
    scores: np.ndarray
    temperature: float
    threshold: float

    def predict(self, text: str) -> tuple[str, float]:
        """Most probable label (the first in order on ties) and its calibrated probability."""
        total, n = np.zeros(len(self.labels)), 0
        for idx in subwords(text):
            total += self.scores.take(idx, axis=0).sum(axis=0, dtype=np.float64)
            n += len(idx)
        p = _softmax(total / max(n, 1) / self.temperature)
        k = int(p.argmax())
        return self.labels[k], float(p[k])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def threshold_of(model: LanguageModel, held: list, parts: list) -> float:
    """Low quantile of the scores of right answers: whole texts, their pieces, and pieces of two labels joined.

    ``held`` has (label number, buckets, weights); ``parts`` per text a (buckets, counts) for each piece length. A
    joined piece is answered right by either label.
    """
    cases = [({y}, idx, w) for y, idx, w in held]
    for k in range(len(PIECE_CHARS)):
        short = [(y, *p[k]) for (y, _, _), p in zip(held, parts) if p and len(p[k][0])]
        cases += [({y}, idx, c / c.sum()) for y, idx, c in short]
        for i, (y, idx, c) in enumerate(short):
            other = next((s for s in short[i + 1:] + short[:i] if s[0] != y), None)
            if other:
                both, at = np.unique(np.concatenate([idx, other[1]]), return_inverse=True)
                w = np.bincount(at, np.concatenate([c, other[2]]))
                cases.append(({y, other[0]}, both, w / w.sum()))
    right = []
    for ys, idx, w in cases:
        p = _softmax(w @ model.scores[idx] / model.temperature)
        if int(p.argmax()) in ys:
            right.append(float(p.max()))
    return float(np.quantile(right, REJECT_QUANTILE)) if right else 0.0


def train(rows: list[tuple], seed: int = 7) -> LanguageModel | None:
    """SGD over (label, buckets, counts, pieces); every fifth row calibrates. No rows: no model."""
    labels = sorted({r[0] for r in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    emb, out = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)), np.zeros((DIM, len(labels)))
    rows = [r for r in rows if len(r[1])]
    data = [(labels.index(r[0]), r[1], r[2] / r[2].sum()) for r in rows]
    fit, held = [d for i, d in enumerate(data) if i % 5], data[::5]
    fit = fit or held
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(fit)):
            y, idx, w = fit[i]
            h = w @ emb[idx]
            g = _softmax(h @ out)
            g[y] -= 1
            back = out @ g
            out -= rate * np.outer(h, g)
            emb[idx] -= rate * np.outer(w, back)
    scores = (emb @ out).astype(np.float32)
    logits = np.array([w @ scores[idx] for _, idx, w in held]).reshape(-1, len(labels))
    gold = np.array([y for y, _, _ in held], dtype=int)
    at = np.arange(len(gold))
    temperature = min(np.geomspace(0.05, 20, 60), default=1.0, key=lambda t: float(
        -np.log(_softmax(logits / t)[at, gold] + 1e-12).sum()))
    model = LanguageModel(labels, scores, float(temperature), 0.0)
    model.threshold = threshold_of(model, held, [r[3] for r in rows[::5]])
    return model


def held_out(id_col: str, folds: int) -> Column:
    """Documents whose crc32(id as text) leaves remainder 1; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        folds: int = 3, train_rows: int = TRAIN_ROWS) -> LanguageModel | None:
    """Fit on at most ``train_rows`` labelled rows outside the held-out fold, evenly over the labels.

    Rows are taken in the order of a hash of id and text: a filter on that hash leaves about
    one and a half times the quota per label, and the quota is cut from those few.
    Only subword counts of the chosen rows reach the driver.
    """
    d = docs.where(F.col(label_col).isNotNull() & ~held_out(id_col, folds) & F.col(text_col).rlike("\\p{L}"))
    sizes = {r["y"]: r["n"] for r in d.groupBy(F.col(label_col).cast("string").alias("y")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    quota = max(2, train_rows // len(sizes))
    d = d.select(F.col(label_col).cast("string").alias("y"), F.col(text_col).alias("t"),
                 F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("o"))
    share = F.create_map(*[x for y, n in sizes.items() for x in (F.lit(y), F.lit(min(1.0, 1.5 * (quota + 20) / n)))])
    d = d.where(F.pmod("o", F.lit(1 << 30)) < share[F.col("y")] * (1 << 30))

    def packed(c: np.ndarray) -> dict:
        i = np.flatnonzero(c).astype(np.uint16)
        return {"i": i.tobytes(), "c": c[i].astype(np.uint32).tobytes()}

    def unpacked(r) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(r["i"], np.uint16).astype(np.int64), np.frombuffer(r["c"], np.uint32).astype(float)

    def features(batches):
        for pdf in batches:
            whole = [packed(counts(t)) for t in pdf["t"]]
            yield pd.DataFrame({"y": pdf["y"], "o": pdf["o"], "i": [x["i"] for x in whole], "c": [x["c"] for x in whole],
                                "p": [[packed(c) for c in pieces(t)] for t in pdf["t"]]})

    rows = d.mapInPandas(features, "y string, o long, i binary, c binary, p array<struct<i:binary,c:binary>>").collect()
    rows.sort(key=lambda r: (r["y"], r["o"], bytes(r["i"])))
    taken: dict[str, list] = {}
    for r in rows:
        if len(mine := taken.setdefault(r["y"], [])) < quota:
            mine.append((r["y"], *unpacked(r), [unpacked(x) for x in r["p"]]))
    return train([x for y in sorted(taken) for x in taken[y]])


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text",
            lang_as: str = "lang_pred", score_as: str = "score", rejected_as: str = "rejected") -> DataFrame:
    """``docs`` with three more columns: label, calibrated score and whether the model rejects the row.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; so is everything
    when there was nothing to learn from.
    """
    if model is None:
        return docs.withColumns({lang_as: F.lit(UNKNOWN), score_as: F.lit(0.0), rejected_as: F.lit(True)})
    # Plain values: the class travels with the function, so workers need no installed package.
    shipped = docs.sparkSession.sparkContext.broadcast((model.labels, model.scores, model.temperature, model.threshold))

    @F.pandas_udf("lang string, score double")
    def apply(texts: pd.Series) -> pd.DataFrame:
        m = LanguageModel(*shipped.value)
        got = [(UNKNOWN, 0.0) if t is None else m.predict(t) for t in texts]
        return pd.DataFrame(got, columns=["lang", "score"])

    letters = F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False))
    d = docs.withColumn("__llm_p", apply(F.when(letters, F.col(text_col))))
    d = d.withColumns({lang_as: F.col("__llm_p.lang"), score_as: F.col("__llm_p.score")}).drop("__llm_p")
    return d.withColumn(rejected_as, (F.col(lang_as) == UNKNOWN) | (F.col(score_as) < F.lit(model.threshold)))
