"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and the DuckDB SQL for each.

Every query reads the given tables (or data Spark derives from them) in full.
Computed columns carry the same alias on both sides; lists are emitted as ', '-joined
text and floating results are rounded, so the two engines can be compared by value.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from postmill import lexicon as L
from postmill.functions import text as TX
from postmill.operators import enrich as EN
from postmill.operators import keywords as KW
from postmill.oracle import fragments as Q
from postmill.sources import tables as TB

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


STORED = f"({Q.stored_posts()})"


def _enriched_sql() -> str:
    ct, cs = Q.strong_clean("title"), Q.strong_clean("selftext")
    return f"""
    SELECT post_id, cleaned_title, cleaned_selftext, masked_author, readable_date, ocr_text,
           {Q.join_text('cleaned_title', 'cleaned_selftext', 'ocr_text')} AS combined
    FROM (SELECT post_id, {ct} AS cleaned_title, {cs} AS cleaned_selftext,
                 {Q.mask_author("coalesce(author, '')")} AS masked_author,
                 {Q.readable_date('created_utc')} AS readable_date, '' AS ocr_text
          FROM {STORED} s) c"""


def _topk_sql(src: str, key: str, tok_expr: str, n: int) -> str:
    """DuckDB: top-n tokens per key by count desc, first position asc -> ', ' text."""
    return f"""
    WITH t AS (SELECT {key}, {tok_expr} AS toks FROM {src}),
    u AS (SELECT {key}, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS pos FROM t),
    g AS (SELECT {key}, tok, count(*) AS n, min(pos) AS first FROM u GROUP BY {key}, tok),
    r AS (SELECT {key}, tok, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, first) AS rk FROM g)
    SELECT t.{key}, coalesce((SELECT string_agg(tok, ', ' ORDER BY rk) FROM r
                               WHERE r.{key} = t.{key} AND rk <= {n}), '') AS keywords
    FROM t"""


def _topics_sql(src: str, key: str, text_expr: str) -> str:
    parts = []
    for i, (name, words) in enumerate(L.TOPICS):
        arr = "[" + ", ".join(Q.q(w) for w in words) + "]"
        parts.append(f"{{'neg': -len(list_intersect(d, {arr})), 'ord': {i}, 'topic': {Q.q(name)}}}")
    ranked = f"list_filter(list_sort([{', '.join(parts)}]), lambda r : r.neg < 0)"
    return f"""
    SELECT {key}, CASE WHEN len(rk) = 0 THEN '{L.DEFAULT_TOPIC}'
                  ELSE array_to_string(list_transform(rk[1:{L.TOPICS_PER_POST}], lambda r : r.topic), ', ') END AS topics
    FROM (SELECT {key}, {ranked} AS rk
          FROM (SELECT {key}, list_distinct({Q.tokens(text_expr)}) AS d FROM {src}) x) y"""


# ---------------------------------------------------------------- posts and text rules

@register("posts_view", Q.POSTS_VIEW)
def posts_view(spark, sf):
    return TB.posts_view(spark, sf)


@register("light_clean", f"SELECT post_id, {Q.light_clean('title')} AS title, "
                         f"{Q.light_clean('selftext')} AS selftext FROM ({Q.POSTS_VIEW}) v")
def light_clean(spark, sf):
    v = TB.posts_view(spark, sf, TB.TEXT_COLUMNS)
    return v.select("post_id", TX.light_clean("title").alias("title"), TX.light_clean("selftext").alias("selftext"))


@register("strong_clean", f"SELECT post_id, {Q.strong_clean('title')} AS cleaned_title, "
                          f"{Q.strong_clean('selftext')} AS cleaned_selftext FROM {STORED} s")
def strong_clean(spark, sf):
    s = TB.stored_posts(spark, sf, TB.TEXT_COLUMNS)
    return s.select("post_id", TX.strong_clean("title").alias("cleaned_title"),
                    TX.strong_clean("selftext").alias("cleaned_selftext"))


@register("html_clean_pages", f"""
    SELECT page_id, length(dec) AS decoded_chars, md5(dec) AS decoded_md5,
           md5({Q.strong_clean('html')}) AS cleaned_md5
    FROM (SELECT page_id, html, {Q.unescape('html')} AS dec FROM pages) p""")
def html_clean_pages(spark, sf):
    p = TB.table(spark, sf, "pages").select("page_id", "html")
    dec = TX.html_unescape("html")
    return p.select("page_id", F.length(dec).cast("bigint").alias("decoded_chars"),
                    F.md5(dec).alias("decoded_md5"), F.md5(TX.strong_clean("html")).alias("cleaned_md5"))


@register("mask_author", f"SELECT post_id, author, {Q.mask_author('author')} AS masked_author FROM ({Q.POSTS_VIEW}) v")
def mask_author(spark, sf):
    v = TB.posts_view(spark, sf, ("post_id", "author"))
    return v.select("post_id", "author", TX.mask_author("author").alias("masked_author"))


@register("readable_date", f"SELECT post_id, created_utc, {Q.readable_date('created_utc')} AS readable_date "
                           f"FROM ({Q.POSTS_VIEW}) v")
def readable_date(spark, sf):
    v = TB.posts_view(spark, sf, ("post_id", "created_utc"))
    return v.select("post_id", "created_utc", TX.readable_date("created_utc").alias("readable_date"))


@register("image_links", f"SELECT post_id, url, domain, is_self, "
                         f"{Q.is_image_link('url', 'domain', 'is_self')} AS is_image FROM ({Q.POSTS_VIEW}) v")
def image_links(spark, sf):
    v = TB.posts_view(spark, sf, ("post_id", "url", "domain", "is_self"))
    return v.select("post_id", "url", "domain", "is_self", TX.is_image_link("url", "domain", "is_self").alias("is_image"))


@register("tokens_per_post", f"""
    SELECT post_id, cast(len(toks) AS bigint) AS n_tokens, md5(array_to_string(toks, ' ')) AS tokens_md5
    FROM (SELECT post_id, {Q.tokens(Q.join_text('title', 'selftext'))} AS toks FROM {STORED} s) t""")
def tokens_per_post(spark, sf):
    s = TB.stored_posts(spark, sf, TB.TEXT_COLUMNS)
    toks = TX.tokens(TX.join_text("title", "selftext"))
    return s.select("post_id", toks.alias("toks")).select(
        "post_id", F.size("toks").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("toks", " ")).alias("tokens_md5"))


@register("keywords_per_post", _topk_sql(f"({_enriched_sql()})", "post_id",
                                         Q.drop_words(Q.tokens("combined")), L.KEYWORDS_PER_POST))
def keywords_per_post(spark, sf):
    e = EN.enrich(TB.stored_posts(spark, sf, TB.TEXT_COLUMNS))
    return e.select("post_id", TX.list_text("keywords").alias("keywords"))


@register("topics_per_post", _topics_sql(f"({_enriched_sql()})", "post_id", "combined"))
def topics_per_post(spark, sf):
    e = EN.enrich(TB.stored_posts(spark, sf, TB.TEXT_COLUMNS))
    return e.select("post_id", TX.list_text("topics").alias("topics"))


@register("enrich_posts", f"""
    SELECT e.post_id, cleaned_title, cleaned_selftext, masked_author, readable_date, ocr_text, k.keywords, t.topics
    FROM ({_enriched_sql()}) e
    JOIN ({_topk_sql(f"({_enriched_sql()})", "post_id", Q.drop_words(Q.tokens("combined")), L.KEYWORDS_PER_POST)}) k
      ON k.post_id = e.post_id
    JOIN ({_topics_sql(f"({_enriched_sql()})", "post_id", "combined")}) t ON t.post_id = e.post_id""")
def enrich_posts(spark, sf):
    e = EN.enrich(TB.stored_posts(spark, sf, TB.ENRICH_COLUMNS))
    return e.select("post_id", "cleaned_title", "cleaned_selftext", "masked_author", "readable_date", "ocr_text",
                    TX.list_text("keywords").alias("keywords"), TX.list_text("topics").alias("topics"))


# ---------------------------------------------------------------- reports

from postmill.operators import report as RP  # noqa: E402
from postmill.sources import listing as LS  # noqa: E402
from postmill.session import scratch_path, stored  # noqa: E402
from postmill.sources import store as ST  # noqa: E402
from postmill import schema as SC  # noqa: E402

VECTORED = f"""(SELECT s.*, e.embedding, e.label AS cluster_id FROM {STORED} s
               LEFT JOIN embeddings e ON cast(e.vec_id AS varchar) = s.post_id)"""


def vectored_posts(spark, sf):
    return TB.stored_posts(spark, sf, ("post_id",)).join(TB.post_vectors(spark, sf), "post_id", "left")


@register("status_counts", f"""
    SELECT count(*) AS total,
           count(*) FILTER (WHERE embedding IS NOT NULL AND len(embedding) > 0) AS embedded,
           count(*) FILTER (WHERE cluster_id IS NOT NULL) AS clustered
    FROM {VECTORED} p""")
def status_counts(spark, sf):
    return RP.status_counts(vectored_posts(spark, sf))


@register("summary_by_source", f"""
    SELECT subreddit, count(*) AS n_posts FROM {STORED} s GROUP BY subreddit
    ORDER BY n_posts DESC, subreddit LIMIT 10""")
def summary_by_source(spark, sf):
    return RP.by_source(TB.stored_posts(spark, sf, ("post_id", "subreddit")))


@register("summary_avgs", f"""
    SELECT count(*) AS total_posts, round(coalesce(avg(score), 0), 6) AS avg_score,
           round(coalesce(avg(num_comments), 0), 6) AS avg_comments FROM {STORED} s""")
def summary_avgs(spark, sf):
    return RP.averages(TB.stored_posts(spark, sf, ("post_id", "score", "num_comments")))


@register("top_posts", f"""
    SELECT post_id, subreddit, score, {Q.cut_title('title')} AS short_title FROM {STORED} s
    ORDER BY score DESC, post_id LIMIT 5""")
def top_posts(spark, sf):
    return RP.top_by_score(TB.stored_posts(spark, sf, ("post_id", "subreddit", "score", "title")))


@register("title_truncate", f"""
    SELECT post_id, {Q.cut_title('title')} AS short_title,
           substr(CASE WHEN ct = '' THEN '{L.NO_TITLE}' ELSE ct END, 1, {L.SEARCH_TITLE_CHARS}) AS search_title,
           substr(CASE WHEN ct = '' THEN '{L.NO_TITLE}' ELSE ct END, 1, {L.SAMPLE_TITLE_CHARS}) AS sample_title
    FROM (SELECT post_id, title, {Q.strong_clean('title')} AS ct FROM {STORED} s) x""")
def title_truncate(spark, sf):
    s = TB.stored_posts(spark, sf, ("post_id", "title")).withColumn("ct", TX.title_or_placeholder(TX.strong_clean("title")))
    return s.select("post_id", TX.cut_title("title").alias("short_title"),
                    TX.prefix("ct", L.SEARCH_TITLE_CHARS).alias("search_title"),
                    TX.prefix("ct", L.SAMPLE_TITLE_CHARS).alias("sample_title"))


USER_SQL = ("SELECT p.subreddit, count(*) AS n_posts, "
            "sum(CASE WHEN p.is_self THEN 1 ELSE 0 END) AS n_self, max(p.score) AS max_score, "
            "count(DISTINCT p.flair) AS n_flairs FROM posts p GROUP BY p.subreddit")


@register("sql_view", f"WITH posts AS {STORED} {USER_SQL}")
def sql_view(spark, sf):
    cols = ("post_id", "subreddit", "is_self", "score", "flair")
    return RP.run_sql(spark, {"posts": TB.stored_posts(spark, sf, cols)}, USER_SQL)


# ---------------------------------------------------------------- ingestion

def _runs(spark, sf):
    """Two landed fetch runs built from the given tables.

    Run 1 (June 1) listed the English posts ('top/all'); run 2 (June 2) listed every
    post twice, in 'hot' (score + 1) and then 'new' (score + 2). Every page also holds
    one non-post child.
    """
    v = TB.posts_view(spark, sf)
    pages = LS.listing_pages(v, [
        ("/top/all", 0, "2024-06-01 00:00:00", F.col("flair") == "en"),
        ("/hot", 1, "2024-06-02 00:00:00", None),
        ("/new", 2, "2024-06-02 00:00:00", None)])
    day1 = F.col("fetched_at") == F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    return pages.where(day1), pages.where(~day1)


def _empty_store(spark):
    return spark.createDataFrame([], SC.POSTS)


_RUNS_SQL = f"""
    WITH v AS ({Q.POSTS_VIEW}),
    arr AS (SELECT v.*, 0 AS bump, '2024-06-01' AS fetched_day, 1 AS run, 0 AS lst FROM v WHERE flair = 'en'
            UNION ALL SELECT v.*, 1, '2024-06-02', 2, 0 FROM v
            UNION ALL SELECT v.*, 2, '2024-06-02', 2, 1 FROM v)"""


def _stored_columns(store):
    """All columns of the posts table, flags as 0/1, times as text and the body as its MD5."""
    day = F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_day")
    out = store.select("post_id", "subreddit", "title", "author", "score", F.round("upvote_ratio", 6).alias("upvote_ratio"),
                       "num_comments", F.date_format("created_utc", "yyyy-MM-dd HH:mm:ss").alias("created"), "url", "permalink",
                       F.md5("selftext").alias("selftext_md5"), "is_self", "over_18", "flair", "domain", day)
    return TB.flags_as_numbers(out)


@register("dedup_append", _RUNS_SQL + f"""
    SELECT post_id, subreddit, {Q.light_clean('title')} AS title, coalesce(author, '[deleted]') AS author,
           coalesce(score + bump, 0) AS score, round(coalesce(upvote_ratio, 0.0), 6) AS upvote_ratio,
           coalesce(num_comments, 0) AS num_comments,
           strftime(coalesce(created_utc, TIMESTAMP '1970-01-01 00:00:00'), '%Y-%m-%d %H:%M:%S') AS created,
           coalesce(url, '') AS url, '{L.PERMALINK_PREFIX}/r/' || subreddit || '/comments/' || post_id AS permalink,
           md5({Q.light_clean('selftext')}) AS selftext_md5, CAST(is_self AS INT) AS is_self, CAST(over_18 AS INT) AS over_18,
           coalesce(flair, '') AS flair, coalesce(domain, '') AS domain, fetched_day
    FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY run, lst) AS rn FROM arr) x
    WHERE rn = 1 AND post_id <> '' AND subreddit IS NOT NULL""")
def dedup_append(spark, sf):
    run1, run2 = _runs(spark, sf)
    store = ST.append(_empty_store(spark), LS.to_posts(run1))
    store = ST.append(store, LS.to_posts(run2))
    return _stored_columns(store)


REQUESTED = 250


@register("requested_total", _RUNS_SQL + f"""
    SELECT post_id, score + bump AS score, fetched_day FROM (
        SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY run, lst) AS rn,
               subreddit || CASE WHEN run = 1 THEN '/top/all' WHEN lst = 0 THEN '/hot' ELSE '/new' END AS listing,
               list_reduce(list_transform(string_split(post_id, ''), lambda c: CAST(c AS BIGINT)), lambda a, b: a * 36 + b) // 100 AS page
        FROM arr) x
    WHERE rn = 1 AND post_id <> '' AND subreddit IS NOT NULL
    ORDER BY run, listing, page, post_id LIMIT {REQUESTED}""")
def requested_total(spark, sf):
    """The posts that an ingestion of a requested total adds: its cap counts over all listings, in arrival order."""
    run1, run2 = _runs(spark, sf)
    new = ST.requested_total(_empty_store(spark), LS.to_posts(run1.unionByName(run2)), REQUESTED)
    return new.select("post_id", "score", F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_day"))


@register("index_append", ORACLES["dedup_append"])
def index_append(spark, sf):
    """Insert-or-ignore through the key index: the second run reads only the buckets it may collide with."""
    from postmill.sources.keyindex import KeyIndex
    base = scratch_path(spark, "indexed")
    index = KeyIndex(spark, f"{base}/index")
    index.build(_empty_store(spark))
    for pages in _runs(spark, sf):
        # First arrivals are stored once; which of them are new is a question to their keys alone.
        new = index.unseen(stored(ST.keep_first(ST.valid(LS.to_posts(pages))), "arrived"))
        keys = new.select("post_id").checkpoint(eager=True)
        ST.write_posts(new.select(*SC.POSTS.fieldNames()), f"{base}/posts")
        index.add(keys)
    return _stored_columns(ST.read_posts(spark, f"{base}/posts"))


WANTED = " src1, ,src2,src19,"


@register("source_filter", f"""
    SELECT post_id, subreddit, score FROM ({Q.POSTS_VIEW}) v WHERE subreddit IN ('src1', 'src2', 'src19')""")
def source_filter(spark, sf):
    """Posts of a comma list of sources from the partitioned store: a partition filter."""
    store = scratch_path(spark, "posts")
    v = TB.posts_view(spark, sf).withColumn("permalink", F.lit("")).withColumn(
        "fetched_at", F.to_timestamp(F.lit("2024-06-01 00:00:00")))
    ST.write_posts(v.select(*[F.col(f.name).cast(f.dataType) for f in SC.POSTS.fields]), store)
    return ST.read_posts(spark, store).where(TB.sources(WANTED)).select("post_id", "subreddit", "score")


@register("listing_cap", f"""
    WITH v AS ({Q.POSTS_VIEW}),
    l AS (SELECT subreddit || '/hot' AS listing, post_id FROM v UNION ALL SELECT subreddit || '/new', post_id FROM v),
    r AS (SELECT listing, row_number() OVER (PARTITION BY listing ORDER BY post_id) AS rn FROM l)
    SELECT listing, count(*) AS n_fetched, count(*) FILTER (WHERE rn <= {L.LISTING_CEILING}) AS n_kept
    FROM r GROUP BY listing""")
def listing_cap(spark, sf):
    _, run2 = _runs(spark, sf)
    rows = LS.to_posts(run2)
    kept = ST.cap_per_listing(rows).groupBy("listing").agg(F.count(F.lit(1)).alias("n_kept"))
    fetched = rows.groupBy("listing").agg(F.count(F.lit(1)).alias("n_fetched"))
    return fetched.join(kept, "listing", "left").select(
        "listing", "n_fetched", F.coalesce("n_kept", F.lit(0)).cast("bigint").alias("n_kept"))


# A ceiling that the given listings exceed.
LOW_CEILING = 20


@register("listing_cap_reached", f"""
    WITH v AS ({Q.POSTS_VIEW}),
    l AS (SELECT subreddit || s.sfx AS listing, post_id,
                 list_reduce(list_transform(string_split(post_id, ''), lambda c: CAST(c AS BIGINT)), lambda a, b: a * 36 + b) // 100 AS page
          FROM v, (VALUES ('/hot'), ('/new')) s(sfx)),
    r AS (SELECT *, row_number() OVER (PARTITION BY listing ORDER BY page, post_id) AS rn FROM l)
    SELECT listing, post_id FROM r WHERE rn <= {LOW_CEILING}""")
def listing_cap_reached(spark, sf):
    """The cap as a feature: which posts of each listing come before a low ceiling."""
    _, run2 = _runs(spark, sf)
    return ST.cap_per_listing(LS.to_posts(run2), ceiling=LOW_CEILING).select("listing", "post_id")


_KW_SQL = _topk_sql(f"({_enriched_sql()})", "post_id", Q.drop_words(Q.tokens("combined")), L.KEYWORDS_PER_POST)
_TOPIC_SQL = _topics_sql(f"({_enriched_sql()})", "post_id", "combined")


@register("schema_evolve", f"""
    SELECT s.post_id,
           CASE WHEN s.flair = 'en' THEN k.keywords ELSE '' END AS keywords,
           CASE WHEN s.flair = 'en' THEN t.topics ELSE '' END AS topics,
           '' AS ocr_text, CASE WHEN s.flair = 'en' THEN 1 ELSE 0 END AS is_processed
    FROM {STORED} s JOIN ({_KW_SQL}) k ON k.post_id = s.post_id JOIN ({_TOPIC_SQL}) t ON t.post_id = s.post_id""")
def schema_evolve(spark, sf):
    cols = TB.TEXT_COLUMNS + ("flair",)
    done = EN.enrich(TB.stored_posts(spark, sf, cols, F.col("flair") == "en")).select(
        "post_id", TX.list_text("keywords").alias("keywords"), TX.list_text("topics").alias("topics"),
        "ocr_text", F.lit(1).alias("is_processed"))
    todo = TB.posts_view(spark, sf, ("post_id", "flair"), F.col("flair") != "en").select("post_id")
    out = ST.evolve([done, todo], {"keywords": "", "topics": "", "ocr_text": "", "is_processed": 0})
    return out.select("post_id", "keywords", "topics", "ocr_text", "is_processed")


@register("pending_posts", f"""
    SELECT s.post_id, k.keywords, t.topics
    FROM {STORED} s JOIN ({_KW_SQL}) k ON k.post_id = s.post_id JOIN ({_TOPIC_SQL}) t ON t.post_id = s.post_id
    WHERE s.flair <> 'en'""")
def pending_posts(spark, sf):
    s = TB.stored_posts(spark, sf, TB.TEXT_COLUMNS + ("flair",))
    enriched = EN.enrich(TB.stored_posts(spark, sf, TB.TEXT_COLUMNS + ("flair",), F.col("flair") == "en"))
    e = EN.enrich_pending(s, enriched)
    return e.select("post_id", TX.list_text("keywords").alias("keywords"), TX.list_text("topics").alias("topics"))


# ---------------------------------------------------------------- vectors and clusters (given labels)

from postmill.functions import vectors as V  # noqa: E402
from postmill.operators import centres as CE  # noqa: E402
from postmill.operators import vectors as VO  # noqa: E402
from postmill.operators import profile as PF  # noqa: E402
from postmill.operators import search as SE  # noqa: E402

EMB = "(SELECT cast(vec_id AS varchar) AS post_id, cast(embedding AS double[]) AS vec, label AS cluster_id FROM embeddings)"
NORMED = f"""(SELECT post_id, cluster_id,
       CASE WHEN nrm > 0 THEN list_transform(vec, lambda x : x / nrm) ELSE list_transform(vec, lambda x : 0.0) END AS u
     FROM (SELECT *, sqrt(list_sum(list_transform(vec, lambda x : x * x))) AS nrm FROM {EMB} e0) e1)"""


def _sums_sql(src: str, key: str, vcol: str) -> str:
    """(key, n, s): member count and componentwise sum list per key."""
    return f"""(SELECT d.{key}, c.n, d.s FROM
      (SELECT {key}, list(s ORDER BY i) AS s FROM
         (SELECT {key}, i, sum(x) AS s FROM
            (SELECT {key}, unnest({vcol}) AS x, unnest(range(len({vcol}))) AS i FROM {src} z0) z1
          GROUP BY {key}, i) z2 GROUP BY {key}) d
      JOIN (SELECT {key}, count(*) AS n FROM {src} z3 GROUP BY {key}) c ON c.{key} = d.{key})"""


def members(spark, sf):
    """Enriched posts that have a stored vector and a given cluster label.

    The vector table is joined to the raw posts first, so only members are cleaned.
    """
    raw = TB.posts_view(spark, sf, TB.TEXT_COLUMNS + ("score", "subreddit"))
    joined = raw.join(given_vectors(spark, sf), "post_id")
    stored = joined.withColumn("title", TX.light_clean("title")).withColumn("selftext", TX.light_clean("selftext"))
    return EN.enrich(stored, keep=("score", "subreddit", "vec", "cluster_id"))


def given_vectors(spark, sf):
    return TB.post_vectors(spark, sf).withColumnRenamed("embedding", "vec")


@register("vector_json_roundtrip", f"""
    SELECT post_id, cast(len(vec) AS int) AS n_values,
           from_json(to_json(vec), '["DOUBLE"]') = vec AS roundtrip_equal,
           round(list_sum(from_json(to_json(vec), '["DOUBLE"]')), 6) AS checksum
    FROM {EMB} e""")
def vector_json_roundtrip(spark, sf):
    g = given_vectors(spark, sf).select("post_id", V.as_double("vec").alias("vec"))
    back = V.from_json_text(V.to_json_text("vec"))
    return g.select("post_id", F.size("vec").alias("n_values"), (back == F.col("vec")).alias("roundtrip_equal"),
                    F.round(V.vsum(back), 6).alias("checksum"))


@register("l2_normalize", f"""
    SELECT post_id, round(sqrt(list_sum(list_transform(u, lambda x : x * x))), 6) AS norm_after,
           round(list_sum(u), 6) AS checksum FROM {NORMED} n""")
def l2_normalize(spark, sf):
    g = given_vectors(spark, sf).select("post_id", V.l2_normalize("vec").alias("u"))
    return g.select("post_id", F.round(V.norm("u"), 6).alias("norm_after"), F.round(V.vsum("u"), 6).alias("checksum"))


@register("cluster_centroids", f"""
    SELECT cluster_id, n, cast(i AS int) AS dim, round(s / n, 6) AS value
    FROM (SELECT cluster_id, n, unnest(s) AS s, unnest(range(len(s))) AS i FROM {_sums_sql(EMB, 'cluster_id', 'vec')} c) x""")
def cluster_centroids(spark, sf):
    c = VO.centroids(given_vectors(spark, sf))
    return c.select("cluster_id", "n", F.posexplode("centroid").alias("dim", "value")) \
        .select("cluster_id", "n", "dim", F.round("value", 6).alias("value"))


@register("nearest_centroid", f"""
    WITH c AS (SELECT cluster_id AS cid, list_transform(s, lambda x : x / n) AS cen FROM {_sums_sql(EMB, 'cluster_id', 'vec')} c0),
    d AS (SELECT e.post_id, e.cluster_id, c.cid, list_sum(list_transform(list_zip(e.vec, c.cen), lambda p : (p[1] - p[2]) * (p[1] - p[2]))) AS d2
          FROM {EMB} e, c)
    SELECT post_id, cluster_id, arg_min(cid, [d2, cid]) AS nearest, round(min(d2), 6) AS sq_dist
    FROM d GROUP BY post_id, cluster_id""")
def nearest_centroid(spark, sf):
    g = given_vectors(spark, sf)
    cents = VO.collect_params(VO.centroids(g), ["centroid"])
    out = VO.nearest_centroid(g, cents)
    return out.select("post_id", "cluster_id", "nearest", F.round("nearest_sq_dist", 6).alias("sq_dist"))


_AUTHORS = "(SELECT cast(substr(v.author, 2) AS bigint) AS cluster_id, e.vec FROM (" + Q.POSTS_VIEW + f") v JOIN {EMB} e ON e.post_id = v.post_id)"


@register("nearest_author", f"""
    WITH c AS (SELECT cluster_id AS cid, list_transform(s, lambda x : x / n) AS cen FROM {_sums_sql(_AUTHORS, 'cluster_id', 'vec')} c0),
    d AS (SELECT e.post_id, c.cid, list_sum(list_transform(list_zip(e.vec, c.cen), lambda p : (p[1] - p[2]) * (p[1] - p[2]))) AS d2
          FROM {EMB} e, c)
    SELECT post_id, arg_min(cid, [d2, cid]) AS nearest, round(min(d2), 6) AS sq_dist FROM d GROUP BY post_id""")
def nearest_author(spark, sf):
    """The author whose mean vector is nearest to each post: authors grow with the posts, so they stay a table."""
    g = given_vectors(spark, sf).select("post_id", "vec")
    authors = TB.posts_view(spark, sf, ("post_id", "author")).select("post_id", F.expr("substr(author, 2)").cast("bigint").alias("cluster_id"))
    best = CE.nearest(g, VO.centroids(g.join(authors, "post_id")))
    return best.select("post_id", "nearest", F.round("value", 6).alias("sq_dist"))


@register("intra_similarity", f"""
    WITH c AS (SELECT cluster_id, n, s, list_transform(s, lambda x : x / n) AS m FROM {_sums_sql(NORMED, 'cluster_id', 'u')} c0 WHERE n >= 2),
    h AS (SELECT *, sqrt(list_sum(list_transform(m, lambda x : x * x))) + 1e-12 AS mn FROM c)
    SELECT round(coalesce(sum(list_dot_product(s, list_transform(m, lambda x : x / mn))) / sum(n), 0.0), 6)
             AS avg_intra_cluster_similarity,
           coalesce(sum(n), 0) AS n_members FROM h""")
def intra_similarity(spark, sf):
    r = VO.intra_similarity(given_vectors(spark, sf))
    return r.select(F.round("avg_intra_cluster_similarity", 6).alias("avg_intra_cluster_similarity"),
                    F.col("n_members").cast("bigint").alias("n_members"))


@register("silhouette_cosine", f"""
    WITH c AS {_sums_sql(NORMED, 'cluster_id', 'u')},
    d AS (SELECT p.post_id, p.cluster_id AS own, c.cluster_id AS cid, c.n, list_dot_product(p.u, c.s) AS xs,
                 list_dot_product(p.u, p.u) AS xx FROM {NORMED} p, c),
    a AS (SELECT post_id, max(CASE WHEN cid = own THEN n END) AS n_own,
                 max(CASE WHEN cid = own AND n > 1 THEN (n - 1 - (xs - xx)) / (n - 1) END) AS a,
                 min(CASE WHEN cid <> own THEN (n - xs) / n END) AS b FROM d GROUP BY post_id)
    SELECT CASE WHEN (SELECT count(*) FROM c) < 2 THEN -1.0
                ELSE round(avg(CASE WHEN n_own <= 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) END
             AS silhouette_cosine,
           count(*) AS n_points FROM a""")
def silhouette_cosine(spark, sf):
    r = VO.silhouette_cosine(given_vectors(spark, sf))
    return r.select(F.round("silhouette_cosine", 6).alias("silhouette_cosine"), "n_points")


@register("silhouette_euclidean", f"""
    WITH e AS (SELECT * FROM {EMB} e0),
    pd AS (SELECT a.post_id, a.cluster_id AS own, b.cluster_id AS cid, list_distance(a.vec, b.vec) AS d
                FROM e a, e b WHERE a.post_id <> b.post_id),
    ag AS (SELECT post_id, own, cid, avg(d) AS md FROM pd GROUP BY post_id, own, cid),
    s AS (SELECT post_id, max(CASE WHEN cid = own THEN md END) AS a, min(CASE WHEN cid <> own THEN md END) AS b
          FROM ag GROUP BY post_id)
    SELECT round(avg(CASE WHEN a IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_euclidean,
           count(*) AS n_points FROM s""")
def silhouette_euclidean(spark, sf):
    r = VO.silhouette_euclidean(given_vectors(spark, sf))
    return r.select(F.round("silhouette_euclidean", 6).alias("silhouette_euclidean"), "n_points")


ENR = f"({_enriched_sql()})"
MEMBERS = f"""(SELECT e.post_id, e.cleaned_title, e.cleaned_selftext, s.score, s.subreddit, v.vec, v.cluster_id
              FROM {ENR} e JOIN {STORED} s ON s.post_id = e.post_id JOIN {EMB} v ON v.post_id = e.post_id)"""


def _group_topk_sql(src: str, key: str, text_expr: str, order_expr: str, n: int, out_rows: bool = False) -> str:
    base = f"""
    WITH t AS (SELECT {key}, {order_expr} AS ord, {Q.drop_words(Q.tokens(text_expr))} AS toks FROM {src} s0 WHERE {key} IS NOT NULL),
    u AS (SELECT {key}, ord, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS pos FROM t),
    g AS (SELECT {key}, tok, count(*) AS n, min({{'o': ord, 'p': pos}}) AS first FROM u GROUP BY {key}, tok),
    r AS (SELECT {key}, tok, n, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, first) AS rk FROM g)"""
    if out_rows:
        return base + f" SELECT {key}, rk AS rank, tok AS word, n AS count FROM r WHERE rk <= {n}"
    return base + f" SELECT {key}, string_agg(tok, ', ' ORDER BY rk) AS cluster_keywords FROM r WHERE rk <= {n} GROUP BY {key}"


CLUSTER_KW_SQL = _group_topk_sql(MEMBERS, "cluster_id", Q.join_text("cleaned_title", "cleaned_selftext"),
                                 "post_id", L.KEYWORDS_PER_CLUSTER)


@register("cluster_keywords", CLUSTER_KW_SQL)
def cluster_keywords(spark, sf):
    k = PF.cluster_keywords(members(spark, sf))
    return k.select("cluster_id", TX.list_text("cluster_keywords").alias("cluster_keywords"))


@register("cluster_sizes", f"""
    SELECT c.cluster_id, c.n_posts, coalesce(k.cluster_keywords, '') AS cluster_keywords
    FROM (SELECT cluster_id, count(*) AS n_posts FROM {MEMBERS} m GROUP BY cluster_id) c
    LEFT JOIN ({CLUSTER_KW_SQL}) k ON k.cluster_id = c.cluster_id""")
def cluster_sizes(spark, sf):
    m = members(spark, sf)
    kw = PF.cluster_keywords(m).select("cluster_id", TX.list_text("cluster_keywords").alias("cluster_keywords"))
    r = RP.cluster_sizes(m, kw)
    return r.select("cluster_id", "n_posts", F.coalesce("cluster_keywords", F.lit("")).alias("cluster_keywords"))


@register("cluster_samples", f"""
    SELECT cluster_id, rank, post_id, title FROM (
      SELECT cluster_id, post_id,
             substr(CASE WHEN coalesce(cleaned_title, '') = '' THEN '{L.NO_TITLE}' ELSE cleaned_title END, 1, {L.SAMPLE_TITLE_CHARS}) AS title,
             row_number() OVER (PARTITION BY cluster_id ORDER BY post_id) AS rank
      FROM {MEMBERS} m) x WHERE rank <= {L.SAMPLE_TITLES_PER_CLUSTER}""")
def cluster_samples(spark, sf):
    return PF.cluster_samples(members(spark, sf)).select("cluster_id", "rank", "post_id", "title")


# ---------------------------------------------------------------- search (queries = benchmark texts)

def clean_texts(spark, sf):
    """Cleaned title/body per post, stored: several branches of one query reuse it."""
    e = EN.enrich(TB.stored_posts(spark, sf, TB.TEXT_COLUMNS))
    return stored(e.select("post_id", "cleaned_title", "cleaned_selftext", "ocr_text"), "texts")


def training(spark, sf, texts=None):
    """Training posts; a null cleaned text falls back to the stored one."""
    raw = TB.stored_posts(spark, sf, TB.TEXT_COLUMNS) if texts is None else None
    return WV.training_posts(texts if texts is not None else clean_texts(spark, sf), raw)


# Word tables learned from the data: a word's vector is the mean stored vector of the
# documents using it (>= 2 documents); a word's bin is the strongest dimension of that vector.

def _doc_tokens(spark, sf, cased: bool, texts=None):
    e = texts if texts is not None else clean_texts(spark, sf)
    text = TX.join_text("cleaned_title", "cleaned_selftext", "ocr_text")
    text = F.when(text == "", F.lit(L.EMPTY_TEXT)).otherwise(text)
    return e.select("post_id", (TX.tokens_cased(text) if cased else TX.tokens(text)).alias("tokens"))


def _word_table(spark, sf, cased: bool, texts=None):
    docs = _doc_tokens(spark, sf, cased, texts).join(given_vectors(spark, sf), "post_id")
    return VO.word_table(docs, "tokens")


def _doc_tokens_sql(cased: bool) -> str:
    tok = Q.tokens_cased if cased else Q.tokens
    txt = f"CASE WHEN {Q.join_text('cleaned_title', 'cleaned_selftext', 'ocr_text')} = '' THEN '{L.EMPTY_TEXT}' " \
          f"ELSE {Q.join_text('cleaned_title', 'cleaned_selftext', 'ocr_text')} END"
    return f"(SELECT post_id, {tok(txt)} AS tokens FROM {ENR} e0)"


def _word_table_sql(cased: bool) -> str:
    return f"""(SELECT word, list(v ORDER BY i) AS vector FROM (
        SELECT word, i, avg(x) AS v, count(*) AS nd FROM (
          SELECT w.word, unnest(e.vec) AS x, unnest(range(len(e.vec))) AS i
          FROM (SELECT post_id, unnest(list_distinct(tokens)) AS word FROM {_doc_tokens_sql(cased)} d0) w
          JOIN {EMB} e ON e.post_id = w.post_id) x0 GROUP BY word, i) x1
        GROUP BY word HAVING min(nd) >= 2)"""


def _bench_q_sql() -> str:
    """Benchmark texts encoded as the mean learned word vector of their tokens (zeros if none)."""
    txt = f"CASE WHEN {Q.py_strip('text')} = '' THEN '{L.EMPTY_TEXT}' ELSE text END"
    return f"""(SELECT b.item_id, b.text AS query_text,
                   coalesce(qv.vec, list_transform(range((SELECT max(len(embedding)) FROM embeddings)), lambda i : CAST(0 AS DOUBLE))) AS query_vec
            FROM benchmark b LEFT JOIN (
              SELECT item_id, list(v ORDER BY i) AS vec FROM (
                SELECT item_id, i, avg(x) AS v FROM (
                  SELECT q.item_id, unnest(t.vector) AS x, unnest(range(len(t.vector))) AS i
                  FROM (SELECT item_id, unnest({Q.tokens_cased(txt)}) AS word FROM benchmark) q
                  JOIN {_word_table_sql(True)} t ON t.word = q.word) a GROUP BY item_id, i) b2
              GROUP BY item_id) qv ON qv.item_id = b.item_id)"""


def bench_queries(spark, sf, m=None):
    """Benchmark texts as search queries, encoded like posts (mean of learned word vectors
    of their case-sensitive tokens; a text with no known word gets a zero vector).

    The word table is learned from the cluster members (only they carry vectors) and only
    for words that occur in some query.
    """
    b = TB.table(spark, sf, "benchmark").select("item_id", F.col("text").alias("query_text"))
    text = F.when(TX.py_strip("query_text") == "", F.lit(L.EMPTY_TEXT)).otherwise(F.col("query_text"))
    toks = b.select("item_id", TX.tokens_cased(text).alias("tokens"))
    m = m if m is not None else members(spark, sf)
    mtext = TX.join_text("cleaned_title", "cleaned_selftext", "ocr_text")
    mtext = F.when(mtext == "", F.lit(L.EMPTY_TEXT)).otherwise(mtext)
    docs = m.select(TX.tokens_cased(mtext).alias("tokens"), "vec")
    words = VO.word_table(docs, "tokens", only=toks.select(F.explode("tokens").alias("word")))
    qv = VO.mean_word_vectors(toks, "tokens", words, key="item_id", dim=TB.vector_width(spark, sf))
    return b.join(qv.select("item_id", F.col("doc_vector").alias("query_vec")), "item_id")


SEM_SQL = f"""
    WITH c AS (SELECT cluster_id, list_transform(s, lambda x : x / n) AS cen FROM {_sums_sql(f"(SELECT * FROM {MEMBERS} m0 WHERE len(vec) > 0)", 'cluster_id', 'vec')} c0),
    sc AS (SELECT q.item_id, q.query_text, c.cluster_id,
                  list_dot_product(q.query_vec, c.cen) / (sqrt(list_dot_product(q.query_vec, q.query_vec)) * sqrt(list_dot_product(c.cen, c.cen)) + 1e-10) AS sim
           FROM {_bench_q_sql()} q, c),
    best AS (SELECT item_id, arg_max(cluster_id, [sim, -cluster_id]) AS bc, max(sim) AS ms FROM sc GROUP BY item_id)
    SELECT q.item_id, CASE WHEN coalesce(b.ms, -1.0) > -1.0 THEN b.bc ELSE 0 END AS best_cluster,
           CASE WHEN coalesce(b.ms, -1.0) > -1.0 THEN b.ms ELSE -1.0 END AS similarity
    FROM {_bench_q_sql()} q LEFT JOIN best b ON b.item_id = q.item_id"""


def _semantic(spark, sf, m=None):
    m = m if m is not None else members(spark, sf)
    return SE.semantic_match(bench_queries(spark, sf, m), m, qvec="query_vec", vec="vec")


def checkpointed_members(spark, sf):
    from postmill.session import checkpoint_dir
    checkpoint_dir(spark)
    return members(spark, sf).checkpoint(eager=True)


@register("search_semantic", f"SELECT item_id, best_cluster, round(similarity, 6) AS similarity FROM ({SEM_SQL}) s")
def search_semantic(spark, sf):
    return _semantic(spark, sf).select("item_id", "best_cluster", F.round("similarity", 6).alias("similarity"))


@register("search_keyword", f"""
    WITH qt AS (SELECT item_id, unnest(list_distinct({Q.drop_words(Q.tokens('text'))})) AS word FROM benchmark),
    kw AS (SELECT cluster_id, unnest(list_distinct(string_split(lower(cluster_keywords), ', '))) AS word FROM ({CLUSTER_KW_SQL}) k0),
    ov AS (SELECT item_id, cluster_id, count(*) AS overlap FROM qt JOIN kw USING (word) GROUP BY item_id, cluster_id),
    best AS (SELECT item_id, arg_max(cluster_id, [overlap, -cluster_id]) AS bc, max(overlap) AS mo FROM ov GROUP BY item_id)
    SELECT b0.item_id, coalesce(best.bc, 0) AS best_cluster, coalesce(best.mo, 0) AS overlap
    FROM benchmark b0 LEFT JOIN best ON best.item_id = b0.item_id""")
def search_keyword(spark, sf):
    q = TB.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    kw = PF.cluster_keywords(members(spark, sf))
    r = SE.keyword_match(q, kw)
    return r.select(F.col("query_id").alias("item_id"), "best_cluster", "overlap")


@register("search_posts", f"""
    WITH m AS (SELECT item_id, best_cluster FROM ({SEM_SQL}) s),
    p AS (SELECT cluster_id, post_id, score, subreddit,
                 substr(CASE WHEN coalesce(cleaned_title, '') = '' THEN '{L.NO_TITLE}' ELSE cleaned_title END, 1, {L.SEARCH_TITLE_CHARS}) AS title,
                 row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, post_id) AS rank,
                 count(*) OVER (PARTITION BY cluster_id) AS cluster_size
          FROM {MEMBERS} m0)
    SELECT m.item_id, m.best_cluster, p.rank, p.post_id, p.score, p.subreddit, p.title, p.cluster_size,
           greatest(p.cluster_size - {L.SEARCH_SHOWN_POSTS}, 0) AS n_more
    FROM m JOIN p ON p.cluster_id = m.best_cluster WHERE p.rank <= {L.SEARCH_SHOWN_POSTS}""")
def search_posts(spark, sf):
    m = checkpointed_members(spark, sf)
    r = SE.search_posts(_semantic(spark, sf, m).select("item_id", "best_cluster"), SE.top_posts_per_cluster(m))
    return r.select("item_id", "best_cluster", "rank", "post_id", "score", "subreddit", "title", "cluster_size", "n_more")


@register("title_histogram", f"""
    WITH m AS (SELECT s.item_id, b.text AS query_text, s.best_cluster FROM ({SEM_SQL}) s
               JOIN benchmark b ON b.item_id = s.item_id),
    h AS ({_group_topk_sql(MEMBERS, "cluster_id", "cleaned_title", "{'s': -score, 'p': post_id}", 10, out_rows=True)})
    SELECT m.item_id, m.best_cluster, h.rank, h.word, h.count, instr(lower(m.query_text), h.word) > 0 AS query_match
    FROM m JOIN h ON h.cluster_id = m.best_cluster""")
def title_histogram(spark, sf):
    mem = checkpointed_members(spark, sf)
    m = _semantic(spark, sf, mem).select("item_id", "query_text", "best_cluster")
    h = PF.title_histogram(mem).withColumnRenamed("cluster_id", "best_cluster")
    return m.join(h, "best_cluster").select(
        "item_id", "best_cluster", "rank", "word", "count",
        (F.instr(F.lower("query_text"), F.col("word")) > 0).alias("query_match"))


# ---------------------------------------------------------------- word tables and document vectors

from postmill.operators import wordvec as WV  # noqa: E402

TRAIN = f"""(SELECT post_id, CASE WHEN len(toks) = 0 THEN ['{L.EMPTY_TEXT}'] ELSE toks END AS tokens
            FROM (SELECT post_id, {Q.tokens('combined')} AS toks FROM {ENR} e0 WHERE combined <> '') t0)"""
VOCAB = f"(SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM {TRAIN} t1) t2 GROUP BY word HAVING count(*) >= 2)"


@register("vocab_min_count", f"SELECT word, n FROM {VOCAB} v")
def vocab_min_count(spark, sf):
    return WV.vocabulary(training(spark, sf))


@register("ppmi_weights", f"""
    WITH p AS (SELECT post_id, word, count(*) AS c FROM (SELECT post_id, unnest(tokens) AS word FROM {TRAIN} t) x
               WHERE word IN (SELECT word FROM {VOCAB} v0) GROUP BY post_id, word),
    d AS (SELECT post_id, sum(c) AS cd FROM p GROUP BY post_id),
    tot AS (SELECT sum(n) AS nn FROM {VOCAB} v1)
    SELECT post_id, word, c, round(ln(c * tot.nn / (d.cd * v.n)), 6) AS ppmi
    FROM p JOIN d USING (post_id) JOIN {VOCAB} v USING (word), tot
    WHERE ln(c * tot.nn / (d.cd * v.n)) > 0""")
def ppmi_weights(spark, sf):
    return WV.ppmi(training(spark, sf)).select("post_id", "word", "c", F.round("ppmi", 6).alias("ppmi"))


@register("mean_word_vector", f"""
    WITH m AS (SELECT d.post_id, t.vector FROM (SELECT post_id, unnest(tokens) AS word FROM {_doc_tokens_sql(True)} d1) d
               JOIN {_word_table_sql(True)} t ON t.word = d.word),
    agg AS (SELECT post_id, count(*) AS n_matched, list(v ORDER BY i) AS vec FROM (
              SELECT post_id, i, avg(x) AS v, count(*) AS cnt FROM (
                 SELECT post_id, unnest(vector) AS x, unnest(range(len(vector))) AS i FROM m) y GROUP BY post_id, i) z
            GROUP BY post_id),
    cnt AS (SELECT post_id, count(*) AS n_matched FROM m GROUP BY post_id)
    SELECT d.post_id, coalesce(cnt.n_matched, 0) AS n_matched,
           round(coalesce(list_sum(agg.vec), 0.0), 6) AS vec_sum,
           round(coalesce(sqrt(list_sum(list_transform(agg.vec, lambda x : x * x))), 0.0), 6) AS vec_norm
    FROM {_doc_tokens_sql(True)} d LEFT JOIN agg ON agg.post_id = d.post_id LEFT JOIN cnt ON cnt.post_id = d.post_id""")
def mean_word_vector(spark, sf):
    texts = clean_texts(spark, sf)
    words = _word_table(spark, sf, cased=True, texts=texts)
    out = VO.mean_word_vectors(_doc_tokens(spark, sf, cased=True, texts=texts), "tokens", words, dim=TB.vector_width(spark, sf))
    return out.select("post_id", "n_matched", F.round(V.vsum("doc_vector"), 6).alias("vec_sum"),
                      F.round(V.norm("doc_vector"), 6).alias("vec_norm"))


@register("word_bins_histogram", f"""
    WITH b AS (SELECT word, list_position(vector, list_max(vector)) - 1 AS bin FROM {_word_table_sql(False)} t),
    x AS (SELECT d.post_id, b.bin FROM (SELECT post_id, unnest(tokens) AS word FROM {TRAIN} t) d JOIN b ON b.word = d.word),
    per AS (SELECT post_id, bin, count(*) AS c FROM x GROUP BY post_id, bin),
    tot AS (SELECT post_id, sum(c) AS m FROM per GROUP BY post_id)
    SELECT t.post_id, per.bin, round(per.c / tot.m, 6) AS weight
    FROM {TRAIN} t LEFT JOIN per ON per.post_id = t.post_id LEFT JOIN tot ON tot.post_id = t.post_id""")
def word_bins_histogram(spark, sf):
    texts = clean_texts(spark, sf)
    words = _word_table(spark, sf, cased=False, texts=texts)
    bins = words.select("word", (F.array_position("vector", F.array_max("vector")) - 1).cast("int").alias("bin"))
    h = VO.bin_histograms(training(spark, sf, texts), "tokens", bins)
    return h.select("post_id", "bin", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------- MLlib, experiment, streaming (rows-only
# unless the final table is deterministic)

from postmill.operators import cluster as CL  # noqa: E402
from postmill.operators import docvec as DV  # noqa: E402
from postmill.operators import encode as EC  # noqa: E402
from postmill.operators import evaluate as EV  # noqa: E402
from postmill.plans import cluster_job as CJ  # noqa: E402
from postmill.plans import experiment as XP  # noqa: E402
from postmill.plans import stages as SG  # noqa: E402
from postmill.streaming import ingest as IG  # noqa: E402


_EACH_NEAREST = "SELECT cast(vec_id AS varchar) AS post_id, true AS in_nearest FROM embeddings"


def _in_nearest(labelled, model):
    """Whether each point's cluster is that of the nearest centre."""
    cents = [{"cluster_id": i, "centroid": list(c)} for i, c in enumerate(model.clusterCenters())]
    n = VO.nearest_centroid(labelled, cents)
    return n.select("post_id", (F.col("nearest") == F.col("cluster_id")).alias("in_nearest"))


@register("kmeans_restarts", _EACH_NEAREST)
def kmeans_restarts(spark, sf):
    g = given_vectors(spark, sf).drop("cluster_id")
    model, _ = CL.kmeans_restarts(g, L.EXPERIMENT_CLUSTERS)
    return _in_nearest(CL.assign(model, g), model)


@register("auto_k")
def auto_k(spark, sf):
    best, rows, _ = CL.auto_k(given_vectors(spark, sf), "post_id")
    return spark.createDataFrame([(r["k"], r["silhouette"], r["training_cost"], r["k"] == best) for r in rows],
                                 "k int, silhouette double, training_cost double, is_best boolean")


@register("pca_2d")
def pca_2d(spark, sf):
    coords, ratio = CL.pca_2d(given_vectors(spark, sf))
    return CL.footprint(coords).withColumn("pc1_variance_ratio", F.lit(ratio[0])) \
        .withColumn("pc2_variance_ratio", F.lit(ratio[1]))


@register("w2v_bins_vectors")
def w2v_bins_vectors(spark, sf):
    vecs, bins = DV.word2vec_bins(training(spark, sf), L.WORD2VEC_CONFIGS[0])
    return vecs.select("post_id", F.lit(bins).alias("bins"), F.size(F.filter("vec", lambda x: x > 0)).alias("n_bins_used"),
                       F.round(V.vsum("vec"), 6).alias("weight_sum"))


@register("paragraph_vectors")
def paragraph_vectors(spark, sf):
    from postmill.operators import paragraph as PV
    vecs = PV.doc_vectors(training(spark, sf), L.DOC_VECTOR_CONFIGS[0])
    return vecs.select("post_id", F.size("vec").alias("dim"), V.norm("vec").alias("norm"))


@register("doc_vectors_als")
def doc_vectors_als(spark, sf):
    from postmill.session import checkpoint_dir
    checkpoint_dir(spark)
    vecs = DV.doc_vectors_als(training(spark, sf), L.DOC_VECTOR_CONFIGS[0])
    return vecs.select("post_id", F.size("vec").alias("dim"), V.norm("vec").alias("norm"))


@register("encoder_batch")
def encoder_batch(spark, sf):
    e = EN.enrich(TB.stored_posts(spark, sf, TB.TEXT_COLUMNS))
    text = TX.join_text("cleaned_title", "cleaned_selftext", "ocr_text")
    out = EC.encode(e.select("post_id", text.alias("text")), "text")
    return out.select("post_id", F.size("embedding").alias("dim"), F.round(V.norm("embedding"), 4).alias("norm"))


def counting_encoder():
    """make_predict_fn of a tiny exact encoder: code points, blanks and letters e of a text."""
    import numpy as np

    def predict(texts):
        return np.array([(len(t), t.count(" "), t.count("e")) for t in texts], np.float32).reshape(-1, 3)
    return predict


_ENCODED = f"(SELECT post_id, CASE WHEN {Q.py_strip('t')} = '' THEN '{L.EMPTY_TEXT}' ELSE t END AS t FROM (SELECT post_id, " \
           f"{Q.join_text('cleaned_title', 'cleaned_selftext', 'ocr_text')} AS t FROM {ENR} e0) e1)"


@register("encoder_exact", f"""
    SELECT post_id, cast(length(t) AS float) AS chars, cast(length(t) - length(replace(t, ' ', '')) AS float) AS blanks,
           cast(length(t) - length(replace(t, 'e', '')) AS float) AS es FROM {_ENCODED} e2""")
def encoder_exact(spark, sf):
    """The encoder stage with an encoder whose vectors are known: texts, batches and order reach it and return whole."""
    e = EN.enrich(TB.stored_posts(spark, sf, TB.TEXT_COLUMNS))
    out = EC.encode(e.select("post_id", TX.join_text("cleaned_title", "cleaned_selftext", "ocr_text").alias("text")), "text", counting_encoder)
    return out.select("post_id", *[F.col("embedding")[i].alias(n) for i, n in enumerate(("chars", "blanks", "es"))])


def _compared(r):
    """The comparison, one row per method; report lists as text."""
    report = F.array_join(F.transform("report", lambda x: F.concat_ws(":", x["cluster_id"], x["size"], x["words"], x["titles"])), ", ")
    return EV.comparison(r).select("method", "family", "place", "wins_dimension", "n_posts", "n_clusters", "vector_dimension",
                                   "silhouette_cosine", "avg_intra_cluster_similarity", report.alias("report"))


@register("compare_embeddings")
def compare_embeddings(spark, sf):
    return _compared(EV.results_frame(spark, XP.run(spark, training(spark, sf))))


# The given vectors under three given labelings, compared like methods: (method, label column in SQL).
LABELINGS = (("doc2vec_label", "cast(e.label AS varchar)"), ("bins_source", "d.source"), ("bins_lang", "d.lang"))


def _labelled_sql(expr: str) -> str:
    return f"""(SELECT post_id, vec, cast(dense_rank() OVER (ORDER BY lab) - 1 AS int) AS cluster_id FROM (
        SELECT cast(e.vec_id AS varchar) AS post_id, cast(e.embedding AS double[]) AS vec, {expr} AS lab
        FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id) l0)"""


def _method_sql(name: str, expr: str) -> str:
    """One record: cosine silhouette and intra similarity of a labelling, from each cluster's sums."""
    src = f"""(SELECT post_id, cluster_id, CASE WHEN nrm > 0 THEN list_transform(vec, lambda x : x / nrm)
               ELSE list_transform(vec, lambda x : 0.0) END AS u
             FROM (SELECT *, sqrt(list_sum(list_transform(vec, lambda x : x * x))) AS nrm FROM {_labelled_sql(expr)} e0) e1)"""
    return f"""
    SELECT '{name}' AS method, (SELECT count(*) FROM p) AS n_posts, (SELECT count(*) FROM c) AS n_clusters,
           (SELECT max(len(u)) FROM p) AS vector_dimension,
           (SELECT round(avg(CASE WHEN n_own <= 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 4) FROM (
              SELECT post_id, max(CASE WHEN cid = own THEN n END) AS n_own,
                     max(CASE WHEN cid = own AND n > 1 THEN (n - 1 - (xs - xx)) / (n - 1) END) AS a,
                     min(CASE WHEN cid <> own THEN (n - xs) / n END) AS b
              FROM (SELECT p.post_id, p.cluster_id AS own, c.cluster_id AS cid, c.n, list_dot_product(p.u, c.s) AS xs,
                           list_dot_product(p.u, p.u) AS xx FROM p, c) d GROUP BY post_id) a0) AS silhouette_cosine,
           (SELECT round(coalesce(sum(list_dot_product(s, list_transform(m, lambda x : x / mn))) / sum(n), 0.0), 4) FROM (
              SELECT *, sqrt(list_sum(list_transform(m, lambda x : x * x))) + 1e-12 AS mn FROM (
                SELECT cluster_id, n, s, list_transform(s, lambda x : x / n) AS m FROM c WHERE n >= 2) h0) h) AS avg_intra_cluster_similarity,
           (SELECT string_agg(concat_ws(':', c.cluster_id, c.n, coalesce(kw.words, ''), coalesce(tt.titles, '')), ', ' ORDER BY c.cluster_id)
              FROM c LEFT JOIN (SELECT cluster_id, string_agg(tok, ' ' ORDER BY rk) AS words FROM (
                     SELECT cluster_id, tok, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, first) AS rk FROM (
                       SELECT cluster_id, tok, count(*) AS n, min({{'o': post_id, 'p': pos}}) AS first FROM (
                         SELECT cluster_id, post_id, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS pos FROM (
                           SELECT p.cluster_id, p.post_id, {Q.drop_words(Q.tokens('d.text'), EV.EXPERIMENT_STOP_WORDS)} AS toks
                           FROM p JOIN documents d ON cast(d.doc_id AS varchar) = p.post_id WHERE p.cluster_id < 3) t0) t1
                       GROUP BY cluster_id, tok) t2) t3 WHERE rk <= 6 GROUP BY cluster_id) kw ON kw.cluster_id = c.cluster_id
              LEFT JOIN (SELECT cluster_id, string_agg(title, ' | ' ORDER BY post_id) AS titles FROM (
                     SELECT p.cluster_id, p.post_id, split_part(d.text, chr(10), 1) AS title,
                            row_number() OVER (PARTITION BY p.cluster_id ORDER BY p.post_id) AS rk
                     FROM p JOIN documents d ON cast(d.doc_id AS varchar) = p.post_id) u0 WHERE rk <= 3 GROUP BY cluster_id) tt ON tt.cluster_id = c.cluster_id
              WHERE c.cluster_id < 3) AS report
    FROM (SELECT 1) one""", src


def _labelings_sql() -> str:
    parts = []
    for i, (name, expr) in enumerate(LABELINGS):
        body, src = _method_sql(name, expr)
        parts.append(f"SELECT {i} AS ord, m.* FROM (WITH p AS {src}, c AS {_sums_sql('p', 'cluster_id', 'u')} {body}) m")
    return f"""
    WITH r AS ({' UNION ALL '.join(parts)}),
    f AS (SELECT *, CASE WHEN method LIKE 'doc2vec%' THEN 'Doc2Vec' ELSE 'Word2Vec+Bins' END AS family FROM r),
    firsts AS (SELECT *, row_number() OVER (PARTITION BY family, vector_dimension ORDER BY ord) AS rn FROM f),
    w AS (SELECT CASE WHEN (a.silhouette_cosine, a.avg_intra_cluster_similarity) >= (b.silhouette_cosine, b.avg_intra_cluster_similarity)
                      THEN a.method ELSE b.method END AS winner
          FROM firsts a JOIN firsts b ON b.vector_dimension = a.vector_dimension
          WHERE a.rn = 1 AND b.rn = 1 AND a.family = 'Doc2Vec' AND b.family <> 'Doc2Vec')
    SELECT method, family, row_number() OVER (ORDER BY silhouette_cosine DESC, avg_intra_cluster_similarity DESC, ord) AS place,
           method IN (SELECT winner FROM w) AS wins_dimension, n_posts, n_clusters, vector_dimension,
           silhouette_cosine, avg_intra_cluster_similarity, report
    FROM f"""


@register("compare_labelings", _labelings_sql())
def compare_labelings(spark, sf):
    docs = TB.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("post_id"), "source", "lang", "text")
    points = (given_vectors(spark, sf).withColumnRenamed("cluster_id", "label").join(docs, "post_id")
              .withColumn("title", F.split_part("text", F.lit("\n"), F.lit(1))))
    from postmill.session import checkpoint_dir
    checkpoint_dir(spark)
    points = points.checkpoint(eager=True)
    named, k = None, {}
    for name, column in zip((n for n, _ in LABELINGS), (F.col("label").cast("string"), F.col("source"), F.col("lang"))):
        # Labels are few (the evaluation checks their number) and numbered in order.
        found = sorted(r[0] for r in points.select(column.alias("lab")).where("lab is not null").distinct().limit(VO.MAX_CLUSTERS + 1).collect())
        ids = spark.createDataFrame(list(enumerate(found)), "cluster_id int, lab string")
        one = points.withColumn("lab", column).join(ids, "lab").select(F.lit(name).alias("method"), "post_id", "vec", "cluster_id")
        named, k[name] = one if named is None else named.unionByName(one), len(found)
    return _compared(EV.results_frame(spark, EV.evaluate_labelings(named, points.select("post_id", "title", "text"), k)))


@register("cluster_job")
def cluster_job(spark, sf):
    out, _, _ = CJ.run(members(spark, sf), k=L.EXPERIMENT_CLUSTERS)
    return out


@register("cluster_job_auto")
def cluster_job_auto(spark, sf):
    """The automatic path: K chosen by silhouette."""
    out, k, _ = CJ.run(members(spark, sf), k=0)
    return out.withColumn("k", F.lit(k))


_DEDUP_SQL = ORACLES["dedup_append"]


@register("stream_ingest", _DEDUP_SQL)
def stream_ingest(spark, sf):
    run1, run2 = _runs(spark, sf)
    base = scratch_path(spark, "stream")
    landing, store, ckpt = f"{base}/landing", f"{base}/posts", f"{base}/ckpt"
    for pages in (run1, run2):
        IG.land(pages, landing)
        IG.run_once(spark, landing, store, ckpt)
    return _stored_columns(ST.read_posts(spark, store))


@register("stage_runner", f"""
    SELECT stage, true AS ok, n AS rows, CAST(NULL AS VARCHAR) AS error
    FROM (SELECT count(*) AS n FROM ({_DEDUP_SQL}) p) x, (VALUES ('ingest'), ('enrich'), ('embed'), ('cluster'), ('posts'), ('embedded'), ('clustered')) s(stage)""")
def stage_runner(spark, sf):
    run1, run2 = _runs(spark, sf)
    return SG.run(spark, [run1, run2])


@register("cluster_write_back", f"""
    SELECT s.post_id, m.cluster_id, coalesce(k.cluster_keywords, '') AS cluster_keywords
    FROM {STORED} s LEFT JOIN {MEMBERS} m ON m.post_id = s.post_id
    LEFT JOIN ({CLUSTER_KW_SQL}) k ON k.cluster_id = m.cluster_id""")
def cluster_write_back(spark, sf):
    posts = TB.posts_view(spark, sf, ("post_id",)).select(
        "post_id", F.lit(None).cast("int").alias("cluster_id"), F.lit("").alias("cluster_keywords"))
    m = members(spark, sf)
    kw = PF.cluster_keywords(m).select("cluster_id", TX.list_text("cluster_keywords").alias("cluster_keywords"))
    labelled = m.select("post_id", "cluster_id").join(kw, "cluster_id", "left")
    return CJ.write_back(posts, labelled).select("post_id", "cluster_id", "cluster_keywords")


@register("cluster_merge", ORACLES["cluster_write_back"])
def cluster_merge(spark, sf):
    """The write-back into the stored table: only sources with a changed row are rewritten."""
    base = scratch_path(spark, "merged")
    TB.posts_view(spark, sf, ("post_id", "subreddit")).select(
        "post_id", "subreddit", F.lit(None).cast("int").alias("cluster_id"), F.lit("").alias("cluster_keywords")
    ).write.partitionBy("subreddit").parquet(f"{base}/posts")
    m = members(spark, sf)
    kw = PF.cluster_keywords(m).select("cluster_id", TX.list_text("cluster_keywords").alias("cluster_keywords"))
    labelled = m.select("post_id", "cluster_id").join(kw, "cluster_id", "left").select("post_id", "cluster_id", "cluster_keywords")
    ST.merge(spark, f"{base}/posts", labelled, f"{base}/staging", "subreddit")
    return spark.read.parquet(f"{base}/posts").select("post_id", "cluster_id", "cluster_keywords")
