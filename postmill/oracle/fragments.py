"""DuckDB SQL fragments mirroring ``postmill.functions.text``.

RE2 (DuckDB) has no Unicode ``\\s``/``\\b``, so the classes are spelled out; lambdas use
the ``lambda x : ...`` form.
"""

from __future__ import annotations

from postmill import lexicon as L

SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NON_SPACE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unescape(x: str) -> str:
    # Only these four entities occur in the driver tables; '&amp' is decoded last.
    for ent, ch in (("&copy;?", "©"), ("&middot;?", "·"), ("&quot;?", '"'), ("&amp;?", "&")):
        x = f"regexp_replace({x}, {q(ent)}, {q(ch)}, 'g')"
    return x


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + SPACE + '+|' + SPACE + '+$')}, '', 'g')"


def light_clean(x: str) -> str:
    x = unescape(f"coalesce({x}, '')")
    x = f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return py_strip(x)


def strong_clean(x: str) -> str:
    x = unescape(f"coalesce({x}, '')")
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    x = f"regexp_replace({x}, {q('https?://' + NON_SPACE + '+|www[.]' + NON_SPACE + '+')}, '', 'g')"
    x = f"regexp_replace({x}, {q('/r/' + WORD + '+|/u/' + WORD + '+|u/' + WORD + '+')}, '', 'g')"
    x = f"regexp_replace({x}, {q(r'[[]removed[]]|[[]deleted[]]')}, '', 'gi')"
    x = f"regexp_replace({x}, {q(r'[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}.,!?;:' + chr(39) + '"-]')}, ' ', 'g')"
    x = f"regexp_replace({x}, {q(SPACE + '+')}, ' ', 'g')"
    return f"trim({x})"


def join_text(*xs: str) -> str:
    return py_strip("concat_ws(' ', " + ", ".join(f"coalesce({x}, '')" for x in xs) + ")")


def tokens(x: str) -> str:
    return (f"list_filter(string_split_regex(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}_]+'), "
            f"lambda t : regexp_full_match(t, '[a-z]{{3,}}'))")


def tokens_cased(x: str) -> str:
    return (f"list_filter(string_split_regex(coalesce({x}, ''), '[^\\p{{L}}\\p{{N}}_]+'), "
            f"lambda t : regexp_full_match(t, '[a-zA-Z]{{2,}}'))")


def stop_list(words=L.STOP_WORDS) -> str:
    return "[" + ", ".join(q(w) for w in sorted(set(words))) + "]"


def drop_words(arr: str, words=L.STOP_WORDS) -> str:
    return f"list_filter({arr}, lambda t : NOT list_contains({stop_list(words)}, t))"


def mask_author(x: str) -> str:
    keep = ", ".join(q(a) for a in L.UNMASKED_AUTHORS)
    return (f"CASE WHEN {x} IS NULL OR {x} = '' OR {x} IN ({keep}) THEN {x} "
            f"ELSE 'user_' || substr(sha256({x}), 1, 8) END")


def readable_date(ts: str) -> str:
    return f"coalesce(strftime({ts}, '%B %d, %Y at %I:%M %p UTC'), '')"


def cut_title(x: str, limit: int = L.SUMMARY_TITLE_CHARS) -> str:
    return f"CASE WHEN length({x}) > {limit} THEN substr({x}, 1, {limit - 1}) || '{L.ELLIPSIS}' ELSE {x} END"


def is_image_link(url: str, domain: str, is_self: str) -> str:
    u = f"lower(coalesce({url}, ''))"
    d = f"coalesce({domain}, '')"
    suf = " OR ".join(f"ends_with({u}, {q(e)})" for e in L.IMAGE_EXTENSIONS)
    host = " OR ".join(f"contains({d}, {q(h)})" for h in L.IMAGE_DOMAINS)
    return f"(NOT coalesce({is_self}, false) AND {u} <> '' AND ({suf} OR {host}))"


POSTS_VIEW = r"""
SELECT cast(d.doc_id as varchar) post_id, d.source subreddit,
       split_part(d.text, chr(10), 1) title,
       'u' || cast(e.user_id as varchar) author,
       cast(floor(e.value * 100) as bigint) score,
       cast(coalesce(l.quality, 0) as double) upvote_ratio,
       cast(d.n_chars % 50 as bigint) num_comments,
       e.ts created_utc, coalesce(p.url, '') url,
       substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) selftext,
       p.url is null is_self, coalesce(l.toxic, 0) = 1 over_18, d.lang flair,
       regexp_extract(coalesce(p.url, ''), '^[a-z]+://([^/?#:]+)', 1) domain
FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id
LEFT JOIN pages p ON p.page_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


def stored_posts() -> str:
    cols = ("post_id, subreddit, author, score, upvote_ratio, num_comments, created_utc, url, "
            "is_self, over_18, flair, domain")
    return (f"SELECT {cols}, {light_clean('title')} AS title, {light_clean('selftext')} AS selftext "
            f"FROM ({POSTS_VIEW}) v")
