"""Quality rules by distribution divergence: character classes and common words against language references.

A language's reference is learned from the corpus: how its characters fall into classes, and how often each of its
common words (those that make up ``COMMON`` of its words or more) is used. A document is compared with every
language's reference by the Jensen-Shannon distance of both histograms, and judged by the nearest language; the
``lang`` column names the references but is not used to judge. Each distance counts only from a minimum length on,
as a short text's histogram is far from any reference by chance. Documents too short or too repetitive fail before.
Only DataFrame functions are used, and the documents themselves are never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.common import let
from postmill.llm.common import BLANKS, ascii_lower, cut, text_or_empty

# Base rule: fewest words, largest share of words in repeated windows (percent), words in a window.
MIN_WORDS, MAX_REPEATED, WINDOW = 20, 30, 8
# A word is common that makes up this share of a language's words, so a language has 500 at most.
COMMON = 0.002
# Languages with less than this share of the words have no reference, so there are 100 at most.
MIN_LANGUAGE = 0.01
# Words are first counted in this many buckets by hash; only those of heavy buckets are counted one by one.
WORD_BUCKETS = 1 << 14
# Fewest characters and words from which the two distances count, and the largest distances that pass.
MIN_CLASS_CHARS, MIN_COMMON_WORDS = 200, 60
MAX_CLASS, MAX_COMMON = 0.25, 0.39

# Character classes and what they hold, as inside the brackets of a pattern; the rest is other punctuation.
PATTERNS = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "wide": "\\x{80}-\\x{10FFFF}", "blank": "\\x20\\x09-\\x0D", "symbol": "#*$%&|<>"}
CLASSES = (*PATTERNS, "other")


def _n_of(text: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{pattern}]+", ""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def repeated_words(ws: Column) -> Column:
    """Words in windows of eight that occur twice or more in the array, the first occurrence included."""
    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(h):
        # Windows in order of hash; those with an equal neighbour are repeated.
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = let(by_hash, lambda s: F.filter(F.transform(s, lambda x, k: F.when(
            (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(F.sort_array(repeated), start, lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    return F.when(F.size(ws) <= WINDOW, 0).otherwise(let(windows(ws), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


@dataclass
class Reference:
    """Common words of all languages: per word its share of the words of each language, in the order of ``langs``."""
    langs: list[str]
    shares: dict[str, list[float]]


def learn_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Reference:
    """The common words of each language, exactly, in two counts: by hash bucket, then by word in heavy buckets.

    A bucket holds at least as many words as any one of its words has occurrences, so that no common word is
    lost, and only a bounded number of distinct words is ever counted one by one.
    """
    w = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.explode(words(ascii_lower(text_or_empty(text_col)))).alias("word"))
    w = w.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(WORD_BUCKETS)))
    buckets = cut(w.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n")))
    sizes = buckets.groupBy("lang").agg(F.sum("n").alias("total"))
    all_words = sizes.agg(F.sum("total")).first()[0] or 0
    sizes = {r["lang"]: r["total"] for r in sizes.where(F.col("total") >= MIN_LANGUAGE * all_words).collect()}
    langs = sorted(sizes)
    if not langs:
        return Reference([], {})
    least = docs.sparkSession.createDataFrame([(x, sizes[x] * COMMON) for x in langs], "lang string, least double")
    # At most 100 languages of 500 heavy buckets each.
    heavy = buckets.join(F.broadcast(least), "lang").where(F.col("n") >= F.col("least")).select("lang", "bucket", "least")
    counts = w.join(F.broadcast(heavy), ["lang", "bucket"]).groupBy("lang", "word", "least").agg(F.count(F.lit(1)).alias("n"))
    shares: dict[str, list[float]] = {}
    for r in counts.where(F.col("n") >= F.col("least")).collect():
        shares.setdefault(r["word"], [0.0] * len(langs))[langs.index(r["lang"])] = r["n"] / sizes[r["lang"]]
    return Reference(langs, dict(sorted(shares.items())))


def _entropy(x: float) -> float:
    return x * math.log2(x) if x > 0 else 0.0


def _x_log_x(x: Column) -> Column:
    return F.when(x > 0, x * F.log2(x)).otherwise(0.0)


def _term(p: Column, q: float) -> Column:
    """One bin's part of the Jensen-Shannon divergence in bits; the logarithms of the mean are split off."""
    return (p + q + _x_log_x(p) + _entropy(q) - _x_log_x(p + q)) / 2


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def common_distances(ws: Column, ref: Reference) -> Column:
    """Distance of the common-word histogram (all other words are one more bin) to each language's reference."""
    if not ref.shares:
        return F.array(*[F.lit(1.0) for _ in ref.langs]).cast("array<double>")
    known = F.filter(ws, lambda w: w.isin(list(ref.shares)))
    # Per word its shares in the languages, then their x log x.
    shares = F.create_map(*[x for w, q in ref.shares.items() for x in (F.lit(w), F.array(*[F.lit(v) for v in (*q, *map(_entropy, q))]))])
    # In order, equal words follow each other: a word's count is the distance to where the next one begins.
    begins = let(F.sort_array(known), lambda k: F.struct(F.size(k).alias("n"), F.transform(F.array_distinct(k), lambda w: F.struct(
        w.alias("w"), F.array_position(k, w).alias("at"))).alias("b")))
    hist = let(begins, lambda x: F.transform(x["b"], lambda y, i: F.struct(
        (F.coalesce(F.get(x["b"], i + 1)["at"], x["n"] + 1) - y["at"]).alias("c"), F.element_at(shares, y["w"]).alias("q"))))
    hist = let(F.struct(hist.alias("h"), F.size(ws).alias("n")), lambda x: F.transform(x["h"], lambda y: let(y["c"] / x["n"], lambda p: F.struct(
        p.alias("p"), (p + p * F.log2(p)).alias("own"), y["q"].alias("q")))))

    def one(k: int, h: Column) -> Column:
        total = sum(q[k] for q in ref.shares.values())
        start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))
        # Bins that the document lacks add half their share each.
        return F.aggregate(h, start, lambda a, x: F.struct(
            (a["d"] + x["own"] + x["q"][len(ref.langs) + k] - (x["p"] + x["q"][k]) * F.log2(x["p"] + x["q"][k])).alias("d"),
            (a["p"] + x["p"]).alias("p"), (a["q"] + x["q"][k]).alias("q")),
            lambda a: _distance((a["d"] + total) / 2 + _term(F.greatest(1 - a["p"], F.lit(0.0)), max(1 - total, 0.0))))

    return let(hist, lambda h: F.array(*[one(k, h) for k in range(len(ref.langs))]))


def class_distance(counts: list[Column], shares: list[float]) -> Column:
    """Distance of the character-class histogram to one language's reference."""
    n = sum(counts[1:], counts[0])
    return _distance(sum((_term(c / n, q) for c, q in zip(counts, shares)), F.lit(0.0)))


def features(docs: DataFrame, ref: Reference, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One narrow row per document: id, language, the base counts, characters by class, common-word distances."""
    text = text_or_empty(text_col)
    d = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text.alias("text"))
    counted = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words"),
        common_distances(F.transform(w, ascii_lower), ref).alias("common")))
    # The frequent classes are taken off once; the others are counted in the little that is left.
    rest = F.regexp_replace("text", f"[{PATTERNS['lower']}{PATTERNS['blank']}]+", "")
    d = d.select("id", "lang", counted.alias("x"), F.char_length("text").alias("n"), duplicate_lines(F.col("text")).alias("n_dup_lines"),
                 _n_of(F.col("text"), PATTERNS["blank"]).alias("blank"), rest.alias("rest"))
    d = d.select("*", *[_n_of(F.col("rest"), PATTERNS[c]).alias(c) for c in ("upper", "digit", "wide", "symbol")])
    d = d.withColumn("word_chars", F.col("n") - F.col("blank")).withColumn("lower", F.col("word_chars") - F.char_length("rest"))
    d = d.withColumn("other", F.col("n") - sum((F.col(c) for c in PATTERNS), F.lit(0)))
    return d.select("id", "lang", *[F.col(c).cast("long").alias(c) for c in CLASSES], *[F.col(c).cast("long").alias(c) for c in ("n", "word_chars", "n_dup_lines")],
                    F.col("x.n_words").cast("long").alias("n_words"), F.col("x.n_repeat_words").cast("long").alias("n_repeat_words"), "x.common")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_class: float = MAX_CLASS, max_common: float = MAX_COMMON) -> DataFrame:
    """One row per input row: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, nearest,
    class_distance, common_distance, kept).

    ``nearest`` is the language of least distance sum (the first by name on ties), null without a reference.
    Distances are null below their minimum length, and without a reference; a null distance fails nobody. Null text
    counts as empty: no words, so the base rule fails. Rows without a language are judged, but teach nothing. Repeated
    rows are judged each. A table without documents gives no rows.
    """
    ref = learn_words(docs, text_col, lang_col)
    d = cut(features(docs, ref, id_col, text_col, lang_col))
    sums = {r["lang"]: [r[c] for c in CLASSES] for r in d.where(F.col("lang").isin(ref.langs)).groupBy("lang").agg(
        *[F.sum(c).alias(c) for c in CLASSES]).collect()} if ref.langs else {}
    per = []
    for k, lang in enumerate(ref.langs):
        total = sum(sums[lang])
        per.append(F.struct(class_distance([F.col(c) for c in CLASSES], [x / total for x in sums[lang]]).alias("by_class"),
                            F.get("common", F.lit(k)).alias("by_word"), F.lit(lang).alias("lang")))
    none = F.lit(None).cast("struct<by_class:double,by_word:double,lang:string>")
    ranked = F.array_sort(F.transform(F.array(*per), lambda x: F.struct((x["by_class"] + x["by_word"]).alias("sum"), x["lang"].alias("lang"), x.alias("x")))) if per else None
    d = d.withColumn("near", F.when(F.col("n") > 0, ranked[0]["x"]) if per else none)
    d = d.select("id", "n_words", "word_chars", F.col("symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
                 ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))).alias("base_failed"),
                 F.col("near.lang").alias("nearest"), F.when(F.col("n") >= MIN_CLASS_CHARS, F.col("near.by_class")).alias("class_distance"),
                 F.when(F.col("n_words") >= MIN_COMMON_WORDS, F.col("near.by_word")).alias("common_distance"))
    kept = ~F.col("base_failed") & (F.coalesce("class_distance", F.lit(0.0)) <= max_class) & (F.coalesce("common_distance", F.lit(0.0)) <= max_common)
    return d.withColumn("kept", kept).withColumnRenamed("id", id_col)
