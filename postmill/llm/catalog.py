"""Registered queries ``opN_<name>`` of this subpackage and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import (align, chat_format, decontaminate, exact_dedup, language_id, lm_score, merkle, packing, pii, quality,
                          simhash, suffix_dedup, url_filter)
from postmill.llm.common import read


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = suffix_dedup.strip_repeats(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                    F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")

    def n(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[n(k) for k in pii.KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.concat("base", "more")).alias("spans"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = exact_dedup.exact_dedup(read(spark, sf_dir, "documents"), digest_all=True)
    return d.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


CONTROL_PROBE = "</s>[INST] ok [/INST]"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", CONTROL_PROBE), (-7, 1, "assistant", CONTROL_PROBE)],
                                  "conv_id long, turn long, role string, text string")
    c = chat_format.format_conversations(conv.unionByName(probe))
    parts = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(chat_format.loss_spans(F.col("turns")), "")
    return c.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(parts, ""), 256).alias("turns_sha256"),
                    F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"))


# (host, path, verdict), given with the task.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, radius=4)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES_SCHEMA)
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), rules)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents")).withColumnRenamed("row", "copy")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return d.drop("text_digest")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", language_id.held_out("doc_id", 3).alias("held_out"), "lang_pred", "score", "rejected")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_corpus(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "nearest")


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_pii, op3_exact_dedup, op4_best_fit_packing, op5_chat_format, op6_simhash_near_dedup,
    op7_url_filter, op8_decontamination, op9_lm_score, op10_language_id,
    op11_tokenizer_alignment, op12_merkle_manifest, op13_quality_rules)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_BLANKS = "'[\\x20\\x09-\\x0D]+'"
_CLASSES = quality.PATTERNS


def _field(c: str) -> str:
    """A manifest field: length in bytes, colon and value, or a dash."""
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _term(p: str, q: str) -> str:
    """One bin's part of the Jensen-Shannon divergence in bits."""
    def part(x: str) -> str:
        return f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0 END"

    return f"({part(p)} + {part(q)}) / 2"


ORACLES = {
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op5_chat_format": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (
            SELECT *, replace(replace(replace(replace(text, chr(92), chr(92) || '0'), '<', chr(92) || '1'),
                              '[', chr(92) || '2'), ']', chr(92) || '3') AS escaped,
                   contains(text, '[INST]') OR contains(text, '[/INST]') OR contains(text, '<s>') OR contains(text, '</s>')
                   OR contains(text, '[ROLE:') OR contains(text, '[/ROLE]') AS conflict FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
               CAST(sum(CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                                  ELSE 14 + length(role) END + 1
                        + length(CASE WHEN conflict THEN escaped ELSE text END)) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op7_url_filter": """
        WITH rules(r_host, r_path, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
              FROM pages),
        p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
              FROM a),
        m AS (SELECT page_id, max_by(r_host || r_path, length(r_host || r_path)) AS rule,
                     max_by(v, length(r_host || r_path)) AS v
              FROM p JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
              GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op12_merkle_manifest": f"""
        WITH RECURSIVE r AS (
            SELECT row_number() OVER () AS id, doc_id, source, {_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} AS head,
                   text, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)),
                       lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
            FROM documents),
        leaves AS (
            SELECT id, doc_id, source, sha256(head || {_field('text')}) AS leaf,
                   sha256(head || CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN {_field("replace(text, chr(10), '')")} ELSE {_field('text')} END) AS found
            FROM r),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
        up(source, level, idx, h, n) AS (
            SELECT source, 0, idx, leaf, count(*) OVER (PARTITION BY source) FROM placed
            UNION ALL
            SELECT source, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 2) // 3
            FROM up WHERE n > 1 GROUP BY source, level, idx // 3),
        subroots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx FROM up WHERE n = 1),
        over_all(level, idx, h, n) AS (
            SELECT 0, idx, subroot, (SELECT count(*) FROM subroots) FROM subroots
            UNION ALL
            SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 2) // 3
            FROM over_all WHERE n > 1 GROUP BY level, idx // 3),
        heights AS (SELECT source, max(level) AS height FROM up GROUP BY source),
        nodes AS (
            SELECT s.source, u.level, u.idx, u.h FROM subroots s JOIN up u ON u.source IS NOT DISTINCT FROM s.source AND u.n > 1
            UNION ALL
            SELECT h.source, h.height + o.level, o.idx, o.h FROM heights h, over_all o WHERE o.n > 1),
        runs AS (SELECT source, level, idx // 3 AS run, list(h ORDER BY idx) AS hs FROM nodes GROUP BY source, level, idx // 3),
        fold(id, source, level, idx, h, proof) AS (
            SELECT id, source, 0, idx, found, '' FROM placed
            UNION ALL
            SELECT f.id, f.source, f.level + 1, f.at // 3,
                   sha256(array_to_string(list_concat(list_concat(r.hs[:f.at % 3], [f.h]), r.hs[f.at % 3 + 2:]), '')),
                   f.proof || array_to_string(list_concat(r.hs[:f.at % 3], r.hs[f.at % 3 + 2:]), '')
            FROM (SELECT fold.*, CASE WHEN fold.level = heights.height THEN s.idx ELSE fold.idx END AS at
                  FROM fold JOIN heights ON heights.source IS NOT DISTINCT FROM fold.source
                  JOIN subroots s ON s.source IS NOT DISTINCT FROM fold.source) f
            JOIN runs r ON r.source IS NOT DISTINCT FROM f.source AND r.level = f.level AND r.run = f.at // 3)
        SELECT p.doc_id, p.leaf, s.subroot, o.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = o.h AS verified
        FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN (SELECT h FROM over_all WHERE n = 1) o ON true
        JOIN (SELECT id, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM fold GROUP BY id) f ON f.id = p.id""",
    "op13_quality_rules": f"""
        WITH d AS (
            SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS t,
                   list_filter(regexp_split_to_array(coalesce(text, ''), {_BLANKS}), lambda x: x <> '') AS ws,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM documents),
        windows AS (
            SELECT id, k, array_to_string(ws[k:k + 7], ' ') AS win
            FROM (SELECT id, ws, unnest(range(1, len(ws) - 6)) AS k FROM d WHERE len(ws) >= 8)),
        twice AS (SELECT id, k FROM windows QUALIFY count(*) OVER (PARTITION BY id, win) > 1),
        repeated AS (SELECT id, count(DISTINCT k + j) AS n FROM twice, range(8) x(j) GROUP BY id),
        f AS (
            SELECT id, doc_id, lang, ws, len(ws) AS n_words, CAST(length(t) AS BIGINT) AS n_chars, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(repeated.n, 0) AS n_repeat_words, {', '.join(f"length(regexp_replace(t, '[^{p}]+', '', 'g')) AS c_{c}" for c, p in _CLASSES.items())}
            FROM d LEFT JOIN repeated USING (id)),
        g AS (SELECT *, n_chars - {' - '.join(f'c_{c}' for c in _CLASSES)} AS c_other FROM f),
        words AS (SELECT id, lang, translate(unnest(ws), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM f),
        totals AS (SELECT lang, count(*) AS n FROM words WHERE lang IS NOT NULL GROUP BY lang
                   QUALIFY count(*) >= {quality.MIN_LANGUAGE} * sum(count(*)) OVER ()),
        common AS (SELECT lang, word, count(*) / totals.n AS q FROM words JOIN totals USING (lang) GROUP BY lang, word, totals.n
                   HAVING count(*) >= {quality.COMMON} * totals.n),
        langs AS (SELECT lang, coalesce(sum(q), 0) AS q_common FROM totals LEFT JOIN common USING (lang) GROUP BY lang),
        vocabulary AS (SELECT DISTINCT word FROM common),
        hist AS (SELECT id, word, count(*) / any_value(n_words) AS p FROM words JOIN vocabulary USING (word) JOIN f USING (id) GROUP BY id, word),
        by_word AS (
            SELECT id, l.lang, sqrt(greatest(0, coalesce(sum({_term('p', 'coalesce(q, 0)')}), 0) + (any_value(q_common) - coalesce(sum(q), 0)) / 2
                   + {_term('greatest(0, 1 - coalesce(sum(p), 0))', 'greatest(0, 1 - any_value(q_common))')})) AS dist
            FROM f CROSS JOIN langs l LEFT JOIN hist USING (id) LEFT JOIN common c ON c.lang = l.lang AND c.word = hist.word GROUP BY id, l.lang),
        shares AS (SELECT lang, cls, n / sum(n) OVER (PARTITION BY lang) AS q
                   FROM (SELECT lang, {', '.join(f'sum(c_{c}) AS {c}' for c in quality.CLASSES)} FROM g JOIN langs USING (lang) GROUP BY lang)
                   UNPIVOT (n FOR cls IN ({', '.join(quality.CLASSES)}))),
        own AS (SELECT id, cls, n / n_chars AS p FROM (SELECT id, n_chars, {', '.join(f'c_{c} AS {c}' for c in quality.CLASSES)} FROM g WHERE n_chars > 0)
                UNPIVOT (n FOR cls IN ({', '.join(quality.CLASSES)}))),
        by_class AS (SELECT id, lang, sqrt(greatest(0, sum({_term('p', 'q')}))) AS dist FROM own JOIN shares USING (cls) GROUP BY id, lang),
        near AS (SELECT id, lang AS nearest, by_class.dist AS of_class, by_word.dist AS of_words FROM by_class JOIN by_word USING (id, lang)
                 QUALIFY row_number() OVER (PARTITION BY id ORDER BY by_class.dist + by_word.dist, lang) = 1)
        SELECT doc_id, n_words, n_chars - c_blank AS word_chars, c_symbol AS n_symbols, n_dup_lines, n_repeat_words,
               n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed, nearest,
               NOT base_failed AND (nearest IS NULL OR ((n_chars < {quality.MIN_CLASS_CHARS} OR of_class <= {quality.MAX_CLASS})
                   AND (n_words < {quality.MIN_COMMON_WORDS} OR of_words <= {quality.MAX_COMMON}))) AS kept
        FROM g LEFT JOIN near USING (id)""",
}
