"""Quality rules against plain Python: base counts, references, distances and the verdict."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postmill.llm import quality
from tests.llm.helpers import empty, rows, table

WORD = r"[^\x20\x09-\x0D]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, n int, x string, q double"


def base(text):
    text = text or ""
    w = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    often = Counter(windows)
    repeated = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            len(w) < 20 or 100 * len(repeated) > 30 * len(w))


def classes(text):
    c = Counter("lower" if "a" <= x <= "z" else "upper" if "A" <= x <= "Z" else "digit" if "0" <= x <= "9" else "wide" if ord(x) > 127 else
                "blank" if x in " \t\n\x0b\f\r" else "symbol" if x in "#*$%&|<>" else "other" for x in text)
    return [c[k] for k in quality.CLASSES]


def jensen_shannon(p, q):
    return math.sqrt(max(0.0, sum(sum(x * math.log2(x / ((a + b) / 2)) for x in (a, b) if x) / 2 for a, b in zip(p, q))))


def share(xs):
    return [x / sum(xs) for x in xs]


def brute(data, max_class, max_common):
    langs = sorted({x for _, _, x in data if x is not None})
    counts = {x: Counter(w for _, t, y in data if x == y for w in re.findall(WORD, (t or "").translate(FOLD))) for x in langs}
    n = sum(sum(c.values()) for c in counts.values())
    langs = [x for x in langs if sum(counts[x].values()) >= quality.MIN_LANGUAGE * n]
    total = {x: sum(counts[x].values()) for x in langs}
    common = sorted({w for x in langs for w, c in counts[x].items() if c >= quality.COMMON * total[x]})
    ref = {x: [counts[x][w] / total[x] if counts[x][w] >= quality.COMMON * total[x] else 0.0 for w in common] for x in langs}
    by_class = {x: share([sum(c) for c in zip(*[classes(t or "") for _, t, y in data if y == x])]) for x in langs}
    for i, t, _ in data:
        b, t = base(t), t or ""
        near = cd = wd = None
        if langs and t:
            c = Counter(re.findall(WORD, t.translate(FOLD)))
            n = max(sum(c.values()), 1)
            p = [c[w] / n for w in common]
            per = [(jensen_shannon(share(classes(t)), by_class[x]), jensen_shannon([*p, 1 - sum(p)], [*ref[x], 1 - sum(ref[x])]), x) for x in langs]
            cd, wd, near = min(per, key=lambda v: (round(v[0] + v[1], 12), v[2]))
        cd = cd if len(t) >= quality.MIN_CLASS_CHARS else None
        wd = wd if b[0] >= quality.MIN_COMMON_WORDS else None
        kept = not b[-1] and (cd or 0) <= max_class and (wd or 0) <= max_common
        yield (i, *b, near, cd and round(cd, 7), wd and round(wd, 7), kept)


def corpus(seed=4):
    rng = random.Random(seed)
    stock = {"en": ["the", "of", "and", "to", "ing", "er"], "de": ["der", "die", "und", "zu", "ä", "ung"], "xx": ["q", "j"]}
    out = []
    for k in range(120):
        lang = rng.choice(["en", "en", "de"])
        own = ["".join(rng.choice("abcdefghilmnorstuéß"[:17 if lang == "en" else 19]) for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(1, 200))]
        out.append((k, " ".join(rng.choice(stock[lang]) if rng.random() < .5 else w + rng.choice(["", "", ".", "\n"]) for w in own), lang))
    out += [(200, "DER DIE UND " * 40, "de"), (201, "a | b $ " * 60, "en"), (202, "eins zwei drei vier fünf sechs sieben acht " * 9, "de"),
            (203, out[0][1].upper(), None), (204, "%%% ### " + out[2][1].replace(" ", " $$$ "), "en"), (205, "9 8 7 " * 100, None), (206, "q j", "xx")]
    out += [(300 + k, t, None) for k, (_, t) in enumerate(rows())] + [(None, out[5][1], "en"), (7, out[7][1], "en"), (7, out[7][1], "en")]
    out += [(400, "x\ny\nx\n \n \n\ny ", None), (401, " ".join("abcdefghi" * 3), None), (402, "a " * 9, None), (403, "\x0b\f\r", "en")]
    return out


def test_quality_equals_brute_force(spark):
    data = corpus()
    df = spark.createDataFrame([(i, t, x, 1, "x", .5) for i, t, x in data], SCHEMA).repartition(5)
    got = [(*r[:8], r[8] and round(r[8], 7), r[9] and round(r[9], 7), r[10]) for r in quality.judge(df, max_class=0.3, max_common=0.5).collect()]
    want = list(brute(data, 0.3, 0.5))
    assert sorted(got, key=str) == sorted(want, key=str)
    verdicts = Counter((r[6], r[-1]) for r in want)
    assert verdicts[False, False] > 3 and verdicts[False, True] > 50 and verdicts[True, False] > 3


def test_quality_without_references_and_of_nothing(spark):
    data = rows()
    got = {(r["doc_id"], r["n_words"], r["base_failed"], r["nearest"], r["kept"]) for r in quality.judge(table(spark, data)).collect()}
    assert got == {(i, base(t)[0], base(t)[5], None, not base(t)[5]) for i, t in data}
    assert quality.judge(empty(spark)).count() == 0


def test_shouted_and_symbol_text_fails_and_clean_text_stays(spark):
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.judge(clean).join(labels, "doc_id").where("not base_failed").selectExpr("quality", "cast(kept as int) as kept")
    kept = {r["quality"]: r["share"] for r in judged.groupBy("quality").agg(F.avg("kept").alias("share")).collect()}
    assert kept[1] >= 0.98 and kept[0] <= 0.1


@pytest.mark.parametrize("n", [8, 9, 16, 17, 40])
def test_repeated_windows_cover_their_words_once(spark, n):
    text = " ".join(["a"] * n)
    got = quality.judge(spark.createDataFrame([(1, text, None)], "doc_id long, text string, lang string")).first()
    assert (got["n_words"], got["n_repeat_words"]) == (n, 0 if n == 8 else n)
