"""Text rules as Spark column expressions.

All rules reproduce Python ``re``/``str`` semantics with Java regex:
Python ``\\w`` on text is ``[\\p{L}\\p{N}_]`` and Python ``\\s`` is Unicode white space
plus U+001C..U+001F, so those classes are spelled out explicitly.
"""

from __future__ import annotations

import html
from collections import Counter
from functools import cache
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill import lexicon as L
from postmill.functions.common import col, let

WORD = r"[\p{L}\p{N}_]"

# Python's white space (``str.isspace``), derived from Python itself: Unicode White_Space
# plus U+001C..U+001F. Used for strip() and for the \s classes of the cleaning rules.
PY_SPACE_CHARS = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def _class_body(chars: str) -> str:
    return "".join(f"\\x{{{ord(ch):x}}}" for ch in chars)


SPACE = f"[{_class_body(PY_SPACE_CHARS)}]"
NON_SPACE = f"[^{_class_body(PY_SPACE_CHARS)}]"
# The same set as a (?U) class; Java matches a Unicode property faster than a long list.
U_SPACE = r"[\s\x1c-\x1f]"
U_NON_SPACE = r"[^\s\x1c-\x1f]"


# Rows of a batch that are Python objects at a time; the others stay in their Arrow buffers.
PYTHON_ROWS = 128


def _by_rows(a: pa.Array, fn) -> pa.Array:
    """``fn`` of every value that is not null, as an array of the same type."""
    parts = []
    for start in range(0, len(a), PYTHON_ROWS):
        part = a.slice(start, PYTHON_ROWS)
        if part.null_count < len(part):
            part = pa.array([None if x is None else fn(x) for x in part.to_pylist()], a.type)
        parts.append(part)
    return pa.concat_arrays(parts) if parts else a


@F.arrow_udf(T.StringType())
def _unescape_arrow(s: pa.Array) -> pa.Array:
    return _by_rows(s, html.unescape)


# The decode is a pure function, but it is flagged non-deterministic on purpose: otherwise
# the optimizer pushes filters on cleaned text (e.g. ``text <> ''``) below the projection by
# inlining the whole cleaning chain into the predicate, so every text would be cleaned, and
# sent to Python, twice. The flag makes the cleaned text a computed-once column.
_unescape_batch = _unescape_arrow.asNondeterministic()


def html_unescape(c) -> Column:
    """HTML entity decoding (named, decimal, hex; one pass), as Python's ``html.unescape``.

    Spark has no built-in for it, so this is an Arrow UDF. Only values that
    contain ``&`` are shipped to Python; all other rows pass a null and keep their text.
    """
    c = col(c)
    return F.coalesce(_unescape_batch(F.when(c.contains("&"), c)), c)


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing white space (no regex: ``btrim``)."""
    return F.btrim(col(c), F.lit(PY_SPACE_CHARS))


def light_clean(c, unescape: bool = True) -> Column:
    """Ingestion clean: decode entities, CRLF/CR -> LF, 3+ LF -> 2, strip; null/'' -> ''."""
    x = F.coalesce(col(c), F.lit(""))
    if unescape:
        x = html_unescape(x)
    x = F.replace(x, F.lit("\r\n"), F.lit("\n"))
    x = F.replace(x, F.lit("\r"), F.lit("\n"))
    x = F.regexp_replace(x, "\n{3,}", "\n\n")
    return py_strip(x)


def _where_found(c: Column, marks, rule) -> Column:
    """``rule`` of the texts that contain one of ``marks``; a text with none, which the rule would leave as it is, is only searched."""
    def body(x):
        found = F.lit(False)
        for m in marks:
            found = found | x.contains(m)
        return F.when(found, rule(x)).otherwise(x)

    return let(c, body)


def strong_clean(c, unescape: bool = True) -> Column:
    """Enrichment clean: decode, drop tags, URLs, mentions, removal markers and odd characters."""
    x = F.coalesce(col(c), F.lit(""))
    if unescape:
        x = html_unescape(x)
    # FIXED VALUES -- the cleaning patterns and their order must match, or cleaned texts change.
    x = _where_found(x, ["<"], lambda t: F.regexp_replace(t, r"<[^>]+>", " "))
    x = _where_found(x, ["http", "www."], lambda t: F.regexp_replace(t, rf"(?U)https?://{U_NON_SPACE}+|www\.{U_NON_SPACE}+", ""))
    x = _where_found(x, ["/r/", "u/"], lambda t: F.regexp_replace(t, rf"/r/{WORD}+|/u/{WORD}+|u/{WORD}+", ""))
    x = _where_found(x, ["["], lambda t: F.regexp_replace(t, r"(?i)\[removed\]|\[deleted\]", ""))
    x = F.regexp_replace(x, r"""(?U)[^\p{L}\p{N}_\s\x1c-\x1f.,!?;:'"-]""", " ")
    x = F.regexp_replace(x, rf"(?U){U_SPACE}+", " ")
    return F.trim(x)


def join_text(*cols) -> Column:
    """``f"{a} {b} ..."`` with null -> '' and a Python-style strip."""
    return py_strip(F.concat_ws(" ", *[F.coalesce(col(c), F.lit("")) for c in cols]))


def _whole_words(c: Column, letters: str) -> Column:
    """The runs of word characters that match ``letters`` as a whole, found in one scan.

    The letter U+20000 stands in the pattern so that Java looks back by code points; it would take a letter of two units apart.
    """
    return F.regexp_extract_all(c, F.lit(rf"(?<![\p{{L}}\p{{N}}_{chr(0x20000)}]){letters}+(?!{WORD})"), F.lit(0))


def tokens(c) -> Column:
    """Lower-cased tokens of 3+ ASCII letters delimited by Unicode word boundaries."""
    return _whole_words(F.lower(F.coalesce(col(c), F.lit(""))), "[a-z]{3,}")


def tokens_cased(c) -> Column:
    """Case-sensitive tokens of 2+ ASCII letters (the word-vector tokeniser)."""
    return _whole_words(F.coalesce(col(c), F.lit("")), "[a-zA-Z]{2,}")


def drop_words(arr, words=L.STOP_WORDS) -> Column:
    """Remove listed words from a token array (inside the row, before any explode)."""
    words = sorted(set(words))
    return F.filter(col(arr), lambda t: ~t.isin(*words))


def _token_lists(a: pa.Array):
    """The rows of a list column (a null row is empty), a few at a time as Python strings."""
    for start in range(0, len(a), PYTHON_ROWS):
        part = a.slice(start, PYTHON_ROWS)
        # By numpy, which turns a whole buffer into strings at once.
        flat = part.flatten().to_numpy(zero_copy_only=False).tolist()
        ends = [0, *accumulate(pc.fill_null(pc.list_value_length(part), 0).to_pylist())]
        yield part, [flat[lo:hi] for lo, hi in zip(ends, ends[1:])]


@cache
def _most_common(n: int):
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def top(a: pa.Array) -> pa.Array:
        parts = [pa.array([[t for t, _ in Counter(x).most_common(n)] for x in rows], a.type, mask=part.is_null().to_numpy(zero_copy_only=False))
                 for part, rows in _token_lists(a)]
        return pa.concat_arrays(parts) if parts else a
    return top


def top_terms(arr, n: int) -> Column:
    """Top-``n`` distinct terms of an array by count desc, ties by first position.

    ``Counter(arr).most_common(n)`` in an Arrow UDF: one pass over each row's terms. No explode, no shuffle.
    """
    return _most_common(n)(col(arr))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("c", T.LongType())])))
def _counted(a: pa.Array) -> pa.Array:
    parts = []
    for _, rows in _token_lists(a):
        found = [Counter(x) for x in rows]
        ends = pa.array([0, *accumulate(len(f) for f in found)], pa.int32())
        words = pa.array([w for f in found for w in f], pa.string())
        parts.append(pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([words, pa.array([n for f in found for n in f.values()], pa.int64())], ["word", "c"])))
    return pa.concat_arrays(parts)


def term_counts(arr) -> Column:
    """(word, c) of each distinct term of an array, in the order of their first places; none for a null array."""
    return _counted(col(arr))


def top_topics(token_arr, n: int = L.TOPICS_PER_POST) -> Column:
    """Topics ranked by distinct-token matches desc, ties in dictionary order, zeros dropped."""
    def with_distinct(d):
        scored = F.array(*[
            F.struct((-F.size(F.array_intersect(d, F.array(*[F.lit(w) for w in words])))).alias("neg"),
                     F.lit(i).alias("ord"), F.lit(name).alias("topic"))
            for i, (name, words) in enumerate(L.TOPICS)])
        ranked = F.filter(F.sort_array(scored), lambda r: r["neg"] < 0)
        picked = F.transform(F.slice(ranked, 1, n), lambda r: r["topic"])
        return F.when(F.size(picked) > 0, picked).otherwise(F.array(F.lit(L.DEFAULT_TOPIC)))

    return let(F.array_distinct(col(token_arr)), with_distinct)


def mask_author(c) -> Column:
    """``user_`` + first 8 hex digits of SHA-256; '', null and service names pass through."""
    c = col(c)
    keep = c.isNull() | (c == "") | c.isin(*L.UNMASKED_AUTHORS)
    return F.when(keep, c).otherwise(F.concat(F.lit("user_"), F.substring(F.sha2(c, 256), 1, 8)))


def readable_date(ts) -> Column:
    """Timestamp -> ``March 05, 2024 at 02:07 PM UTC``; null -> ''."""
    return F.coalesce(F.date_format(col(ts), L.READABLE_DATE_FORMAT), F.lit(""))


def readable_date_text(c) -> Column:
    """ISO text -> readable form; '' -> ''; unparsable text is returned unchanged.

    The wall clock is printed as written (a UTC offset is not applied), like the original;
    a bare year such as '2024' is not a date there, hence the date-prefix guard.
    """
    c = col(c)
    parsed = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), c.try_cast("timestamp_ntz"))
    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(
        F.coalesce(F.date_format(parsed, L.READABLE_DATE_FORMAT), c))


def cut_title(c, limit: int = L.SUMMARY_TITLE_CHARS) -> Column:
    """Summary title: longer than ``limit`` chars -> first ``limit - 1`` chars + an ellipsis."""
    c = col(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 1), F.lit(L.ELLIPSIS))).otherwise(c)


def prefix(c, n: int) -> Column:
    """Python ``s[:n]``."""
    return F.substring(col(c), 1, n)


def title_or_placeholder(c) -> Column:
    c = col(c)
    return F.when(c.isNull() | (c == ""), F.lit(L.NO_TITLE)).otherwise(c)


def is_image_link(url, domain, is_self) -> Column:
    """Not a self post, non-empty URL, and an image suffix or an image host substring."""
    u = F.lower(F.coalesce(col(url), F.lit("")))
    d = F.coalesce(col(domain), F.lit(""))
    by_suffix = F.lit(False)
    for ext in L.IMAGE_EXTENSIONS:
        by_suffix = by_suffix | u.endswith(ext)
    by_host = F.lit(False)
    for host in L.IMAGE_DOMAINS:
        by_host = by_host | d.contains(host)
    return (~F.coalesce(col(is_self), F.lit(False))) & (u != "") & (by_suffix | by_host)


def url_host(c) -> Column:
    return F.coalesce(F.try_parse_url(col(c), F.lit("HOST")), F.lit(""))


def list_text(arr) -> Column:
    """A list stored as text, items joined by ', '."""
    return F.coalesce(F.array_join(col(arr), ", "), F.lit(""))


def text_list(c) -> Column:
    """Inverse of ``list_text``: split on ',', trim, drop blanks."""
    return F.filter(F.transform(F.split(F.coalesce(col(c), F.lit("")), ","), lambda x: F.trim(x)),
                    lambda x: x != "")
