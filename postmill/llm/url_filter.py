"""URL filter: host-suffix and path-prefix expressions, joined to the rules by a short hash prefix.

Each URL is expanded into every (host suffix, path prefix that ends in ``/``) expression a rule
could be filed under. Expressions and rules meet in an equi-join on the first 32 bits of the
expression's SHA-256; the full digest, the rest of the rule's path and the rule's precedence are
confirmed after the join. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.common import let
from postmill.llm.common import ascii_lower

RULES_SCHEMA = "host string, path string, verdict string"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://``, A-Z lower-cased; the path up to ``?`` or ``#``."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), "^[^?#]*", 0)
    return ascii_lower(host), path


def _digest(host: Column, anchor: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), anchor), 256)


def _anchor(path: Column) -> Column:
    """A rule is filed under its path up to the last slash; the rest is checked after the join."""
    return F.regexp_extract(path, "(?s)^.*/", 0)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Distinct usable rules with their digests. Rules with a null field or an unknown verdict are left out."""
    r = rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"),
                     F.col("verdict").alias("r_verdict"))
    r = r.where(F.col("r_verdict").isin("block", "allow") & F.col("r_host").isNotNull() & F.col("r_path").isNotNull())
    r = r.distinct().withColumn("r_digest", _digest(F.col("r_host"), _anchor(F.col("r_path"))))
    return r.withColumn("r_short", F.substring("r_digest", 1, 8))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Verdict of every URL: (id, host, path, rule, verdict), one row per input row.

    A rule fits its host and all subdomains when the URL's path starts with the rule's path; the
    longest rule (host and path together) wins, then the longer host, then ``block`` over
    ``allow``. Without a rule: ``rule`` null and ``default``. A null URL, or one without ``://``,
    has an empty host and path. Rules are any size: the join decides itself whether to broadcast
    them. Equal URLs are judged once, so a hot host is one row per path before the join.
    """
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    r = prepare_rules(rules)
    # How deep rules reach bounds how many expressions a URL (however long) is expanded to.
    reach = r.agg(F.max(F.size(F.split("r_host", "\\."))), F.max(F.size(F.split("r_path", "/")) - 1)).first()
    n_labels, n_slashes = int(reach[0] or 0), int(reach[1] or 0)
    one = urls.select("host", "path").distinct()
    suffixes = let(F.split("host", "\\."), lambda labels: F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(n_labels, 1)))),
        lambda k: F.array_join(F.slice(labels, -k, k), ".")))
    prefixes = let(F.split("path", "/"), lambda parts: F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(n_slashes))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/")))))
    expr = (one.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
            .withColumn("digest", _digest(F.col("suffix"), F.col("prefix"))))
    expr = expr.select("host", "path", "digest", F.substring("digest", 1, 8).alias("short"))
    hit = expr.join(r, F.col("short") == F.col("r_short")).where(
        (F.col("digest") == F.col("r_digest")) & F.startswith(F.col("path"), F.col("r_path")))
    rank = F.struct(F.length(F.concat("r_host", "r_path")).alias("n"), F.length("r_host").alias("h"),
                    (F.col("r_verdict") == "block").alias("b"),
                    F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("v"))
    best = hit.groupBy("host", "path").agg(F.max(rank).alias("best"))
    best = best.select(F.col("host").alias("b_host"), F.col("path").alias("b_path"), "best")
    out = urls.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left")
    return out.select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce(F.col("best.v"), F.lit(default)).alias("verdict"))
