"""Personal data: pattern spans, then information-theoretic sanitisation of what gives them away.

Patterns find the protected entities (e-mail addresses, IP addresses, card and phone numbers). Other terms
of a document may still reveal an entity that it mentions, once the mention is masked. How strongly is
estimated from the corpus: over all documents, ``PMI(t; e) / IC(e)`` with ``PMI = log(N n_te / (n_t n_e))``
and ``IC(e) = log(N / n_e)``, where ``n_t`` documents hold term t, ``n_e`` mention entity e and ``n_te``
do both. The ratio is 1 when t occurs only with e, about 0 when they are independent. Every occurrence of
a term in a document that mentions e is generalised (replaced by its word shape) from one threshold on and
removed from a higher one. Pattern spans are never changed by this.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import bitmap, cut, flagged, text_or_empty

KINDS = ("email", "ip", "card", "phone")
GENERALISE_AT = 0.9
REMOVE_AT = 0.98
# Documents that must hold a term and the entity: one is no evidence of a link.
MIN_DOCUMENTS = 2
# Terms of rows are handed back in frames of about so many.
ROWS_OUT = 50_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at the first digit of a run, so the look-behinds change no result; they
# keep long digit runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, normalised value) by kind, then start: leftmost and non-overlapping per kind."""
    out = []
    if "@" in text:
        out += [("email", a, b, text[a:b].lower()) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end(), m[0]))
    for m in _CARD.finditer(text):
        if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end(), d))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(d := _digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end(), d))
    return out


def free_terms(text: str, spans: list) -> list[tuple[str, int, int]]:
    """(term, start, end) of every term outside all pattern spans."""
    starts, ends = [], []
    for a, b in sorted((a, b) for _, a, b, _ in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def free(s: int, e: int) -> bool:
        k = bisect_left(starts, e) - 1  # the last masked run that begins before e
        return k < 0 or ends[k] <= s

    return [(m[0].lower(), m.start(), m.end()) for m in _TERM.finditer(text) if free(m.start(), m.end())]


def _scan(batches):
    for pdf in batches:
        rows = []
        for row, text in zip(pdf["row"], pdf["text"]):
            spans = base_spans(text)
            rows.append((row, [{"kind": k, "s": a, "e": b} for k, a, b, _ in spans],
                         sorted({f"{k}:{v}" for k, _, _, v in spans}), text if spans else None))
        yield pd.DataFrame(rows, columns=["row", "base", "entities", "text"])


def _terms_of_rows(batches):
    """(row, term), distinct, of texts with a mention."""
    for pdf in batches:
        rows = []
        for row, text in zip(pdf["row"], pdf["text"]):
            rows += [(row, t) for t in {t for t, _, _ in free_terms(text, base_spans(text))}]
            if len(rows) > ROWS_OUT:
                yield pd.DataFrame(rows, columns=["row", "term"])
                rows = []
        yield pd.DataFrame(rows, columns=["row", "term"])


def _marks(batches):
    """(row, more): every occurrence of the row's disclosing terms, by start."""
    for pdf in batches:
        out = []
        for row, text, terms in zip(pdf["row"], pdf["text"], pdf["terms"]):
            kinds = {x["term"]: x["kind"] for x in terms}
            out.append((row, [{"kind": kinds[t], "s": a, "e": b} for t, a, b in free_terms(text, base_spans(text)) if t in kinds]))
        yield pd.DataFrame(out, columns=["row", "more"])


def _term_documents(batches):
    """Documents per term, counted over a partition's batch before the shuffle."""
    for pdf in batches:
        c = Counter()
        for text in pdf["text"]:
            c.update({t.lower() for t in set(_TERM.findall(text))})
        yield pd.DataFrame({"term": list(c.keys()), "n": list(c.values())})


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """Spans of every row: (id, base array<kind, s, e>, more array<kind, s, e>), code points, end exclusive.

    ``base`` holds the pattern spans by kind (email, ip, card, phone), then start; ``more`` the terms
    that disclose a protected entity, kind ``generalise`` or ``remove``, by start. Null text counts
    as empty. Rows are scanned one by one, so repeated rows get equal spans and count as documents.
    """
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    scanned = texts.select("id", F.monotonically_increasing_id().alias("row"), "text")
    scanned = scanned.withColumn("ids", F.struct("id", "row")).select(F.col("ids").alias("row"), "text").mapInPandas(
        _scan, f"row struct<id:{texts.schema['id'].dataType.simpleString()},row:bigint>, "
               "base array<struct<kind:string,s:long,e:long>>, entities array<string>, text string")
    # Row numbers are fixed by writing them out; texts without a mention stay behind.
    scanned = cut(scanned.select("row.id", "row.row", "base", "entities", "text"))
    n = scanned.count()
    mentions = scanned.select("row", F.explode("entities").alias("entity"))
    entities = mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    # An entity of fewer documents has no term in MIN_DOCUMENTS of them; one of all documents has no information.
    entities = cut(entities.where((F.col("n_e") >= MIN_DOCUMENTS) & (F.col("n_e") < n)))
    most = entities.agg(F.max("n_e").alias("n")).first()["n"] or 0
    terms = texts.select("text").mapInPandas(_term_documents, "term string, n long")
    terms = terms.groupBy("term").agg(F.sum("n").alias("n_t"))
    # As n_te is at most n_e, the ratio is below the threshold for n_t > n^(1 - threshold) * n_e^threshold.
    bound = float(max(n, 1)) ** (1 - generalise_at) * float(most) ** generalise_at
    terms = terms.where((F.col("n_t") >= MIN_DOCUMENTS) & (F.col("n_t") <= bound * (1 + 1e-9)))
    # Bitmaps of both tell, without a shuffle, the pairs of a document that no link can concern.
    mentions = flagged(mentions, bitmap(entities, "entity"), "entity").where("__llm_maybe").select("row", "entity")
    held = scanned.where(F.size("entities") > 0).select("row", "text").join(mentions.select("row").distinct(), "row", "left_semi")
    held = held.mapInPandas(_terms_of_rows, "row long, term string")
    terms = cut(terms.join(held.select("term").distinct(), "term", "left_semi"))
    held = flagged(held, bitmap(terms, "term"), "term").where("__llm_maybe").select("row", "term")
    pairs = held.join(mentions, "row")
    joint = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te")).where(F.col("n_te") >= MIN_DOCUMENTS)
    ratio = F.log(F.lit(float(max(n, 1))) * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / F.log(
        F.lit(float(max(n, 2))) / F.col("n_e"))
    links = cut(joint.join(entities, "entity").join(terms, "term").withColumn("ratio", ratio)
                .where(F.col("ratio") >= generalise_at).select("entity", "term", "ratio"))
    found = (flagged(pairs, bitmap(links, "entity", "term"), "entity", "term").where("__llm_maybe").join(links, ["entity", "term"])
             .groupBy("row", "term").agg(F.max("ratio").alias("r"))
             .withColumn("kind", F.when(F.col("r") >= remove_at, "remove").otherwise("generalise"))
             .groupBy("row").agg(F.collect_list(F.struct("term", "kind")).alias("terms")))
    spans = (scanned.select("row", "text").join(found, "row")
             .mapInPandas(_marks, "row long, more array<struct<kind:string,s:long,e:long>>"))
    scanned = scanned.drop("text")
    out = scanned.join(spans, "row", "left")
    none = F.expr("cast(array() as array<struct<kind:string,s:long,e:long>>)")
    return out.select(F.col("id").alias(id_col), "base", F.coalesce("more", none).alias("more"))


def redact(text: str, base: list, more: list) -> str:
    """The text with pattern spans masked by kind, terms generalised to their shape or removed."""
    parts, last = [], 0
    for kind, s, e in sorted([*base, *more], key=lambda x: (x[1], -x[2])):
        if s < last:
            continue
        word = text[s:e]
        new = ("" if kind == "remove" else f"<{kind.upper()}>" if kind != "generalise"
               else "<NAME>" if word[:1].isupper() else "<WORD>")
        parts += [text[last:s], new]
        last = e
    return "".join([*parts, text[last:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text sanitised, other columns as they are; rows without spans pass unchanged.

    Spans meet their rows by id and text digest, so equal ids with other texts stay apart.
    """
    keyed = docs.withColumn("__llm_d", F.sha2(text_or_empty(text_col), 256))
    found = find(keyed.select(id_col, F.col(text_col).alias("text")).withColumnRenamed(id_col, "id0")
                 .withColumn("id0", F.struct(F.col("id0").cast("string").alias("i"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("d"))),
                 "id0", "text")
    found = found.where((F.size("base") > 0) | (F.size("more") > 0)).groupBy("id0").agg(
        F.first("base").alias("__llm_base"), F.first("more").alias("__llm_more"))
    found = found.select(F.col("id0.i").alias("__llm_i"), F.col("id0.d").alias("__llm_dd"), "__llm_base", "__llm_more")

    @F.pandas_udf("string")
    def cleaned(t: pd.Series, b: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([x if y is None else redact(x, [(v["kind"], v["s"], v["e"]) for v in y], [(v["kind"], v["s"], v["e"]) for v in z])
                          for x, y, z in zip(t, b, m)], dtype=object)

    cond = (F.col("__llm_d") == F.col("__llm_dd")) & F.col(id_col).cast("string").eqNullSafe(F.col("__llm_i"))
    out = keyed.join(found, cond, "left").withColumn("__llm_t", cleaned(F.col(text_col), "__llm_base", "__llm_more"))
    return out.withColumn(text_col, F.col("__llm_t")).select(*docs.columns)
