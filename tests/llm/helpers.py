"""Small tables with the awkward cases every operator must stand: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, id string, key string, row int"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = [a + b for a in ("ba", "ko", "li", "ne", "su", "ra", "mi", "to") for b in ("", "n", "ra", "lis", "mond", "tek")]


def lower(t):
    return (t or "").translate(FOLD)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows(seed=3):
    """(doc_id, text): random prose with exact copies, near copies, shared passages and the awkward rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    passage = prose(rng, 30)
    out = [(i, t) for i, t in enumerate(base)]
    out += [(100 + i, base[i].upper()) for i in range(5)] + [(110 + i, base[0]) for i in range(4)]
    out += [(120 + i, base[i + 5] + " " + passage + " " + base[i + 6]) for i in range(8)]
    long = prose(rng, 20_000)
    out += [(140, long), (141, long.replace("balis", "kotek", 3)), (142, base[7] + " x"), (143, "x " + base[7])]
    out += [(150, None), (151, ""), (152, " \t\n "), (153, "1234 !!"), (154, "é"), (155, "ÄÖ ß naïve 中文 😀")]
    out += [(None, base[1]), (None, base[1]), (None, None), (20, base[20]), (20, base[20]), (21, "another text with id 21")]
    return out


def table(spark, data):
    """A documents table with further columns whose names operators may use inside."""
    return spark.createDataFrame([(i, t, None, f"x{i}", "k", 1) for i, t in data], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
