"""Pluggable text encoder run as an Arrow-batched ``predict_batch_udf``.

The encoder is the caller's ``make_predict_fn`` (e.g. a sentence encoder loaded once per
Python worker). The bundled default is a small feature-hashing encoder, so the stage runs
without any downloaded model.
"""

from __future__ import annotations

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill import lexicon as L
from postmill.functions import text as TX


# Names the vectors of the default encoder; any change of its results needs another name.
DEFAULT_VERSION = "hashing-384"
# Words whose hashes a worker remembers between texts.
HELD_WORDS = 200_000


def hashing_encoder(dim: int = 384):
    """make_predict_fn for a signed feature-hashing bag of lower-cased words, L2-normalised."""
    def make_predict_fn():
        import re

        from hashlib import blake2b

        import numpy as np

        word = re.compile(r"[^\W\d_]{2,}")
        places: dict = {}

        def place(w):
            h = int.from_bytes(blake2b(w.encode(), digest_size=8).digest(), "big")
            places[w] = p = h % dim + (dim if (h >> 63) & 1 else 0)
            return p

        def predict(texts):
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for i, t in enumerate(texts):
                if len(places) > HELD_WORDS:
                    places.clear()
                words = word.findall(str(t).lower())
                n = np.bincount([places[w] if w in places else place(w) for w in words], minlength=2 * dim) if words else np.zeros(2 * dim)
                out[i] = n[dim:] - n[:dim]
            n = np.linalg.norm(out, axis=1, keepdims=True)
            return np.divide(out, n, out=np.zeros_like(out), where=n > 0)
        return predict
    return make_predict_fn


def encode(df: DataFrame, text_col: str, make_predict_fn=None, dim: int = 384,
           batch_size: int = L.ENCODER_BATCH, out: str = "embedding") -> DataFrame:
    """Embed a text column in batches of ``batch_size``; blank text is encoded as 'empty'."""
    fn = make_predict_fn or hashing_encoder(dim)
    udf = predict_batch_udf(fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
                            input_tensor_shapes=None)
    text = F.when(TX.py_strip(F.coalesce(F.col(text_col), F.lit(""))) == "", F.lit(L.EMPTY_TEXT)).otherwise(F.col(text_col))
    return df.withColumn(out, udf(text))


def stale(posts: DataFrame, vectors: DataFrame, version: str, key: str = "post_id") -> DataFrame:
    """Posts without a vector of this encoder version; vectors of other versions (column ``encoder``) do not count."""
    return posts.join(vectors.where(F.col("encoder") == version).select(key).distinct(), key, "left_anti")
