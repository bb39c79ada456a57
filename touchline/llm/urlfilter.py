"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is compiled to a regular expression and a set of literal tokens
that any matching URL must contain whole. The rule is filed under the one of
them that the fewest URLs of this corpus hold. A URL is cut into its tokens,
each token fetches the rules filed under it, and only those rules run their
expression. Rules without a usable token are filed under the empty token,
which every URL holds.

Rules
    ``host``     ``example.net/en/``: fits the host and all its subdomains if
                 the URL's path starts with the rule's path. Case matters in
                 the path only.
    ``pattern``  ``*`` any text, ``^`` a separator or the end, a leading ``||``
                 the start of a host label, a leading or trailing ``|`` the
                 start or end of the URL. Case does not matter.

The longest fitting host rule decides; ties go to the greater rule text. If
none fits, an ``allow`` pattern beats a ``block`` pattern, and no pattern at
all means ``allow``.

Defined results: a NULL URL or one without ``://`` has an empty host and path
(patterns still apply to the text of the latter). Repeated rows each get a
row. An empty rule table allows everything. Other columns of the input are
not read, so clashing names do no harm.

All of it is DataFrame expressions. The join on tokens and the final join on
URLs are left to Spark: a small rule index is broadcast because its size is
known, a hot URL is split by the skew-join rule. URLs are reduced to distinct
ones before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import ascii_lower

#: Rules fixed by the query's contract.
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"),
              ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Pattern rules of the production list.
PATTERN_RULES = (
    ("cheap-pills.", "block"), ("-casino.", "block"), (".casino.", "block"),
    ("||casino.", "block"), ("/adserver/", "block"), ("/banner/", "block"),
    ("/tracker^", "block"), ("/wp-login^", "block"), ("||ads.", "block"),
    ("/porn^", "block"), ("/viagra^", "block"), ("*free*download*crack*", "block"),
    ("||health.gov^", "allow"),
)

RULE_SCHEMA = "rule string, action string, kind string"


def default_rules(spark: SparkSession) -> DataFrame:
    rows = [(r, a, "host") for r, a in HOST_RULES] + [(r, a, "pattern") for r, a in PATTERN_RULES]
    values = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(a).alias("action"),
                                F.lit(k).alias("kind")) for r, a, k in rows])
    return spark.range(1).select(F.inline(values))


def compile_rules(rules: DataFrame) -> DataFrame:
    """rule, action, kind, regex, tokens (distinct, each whole in any match)."""
    escaped = F.regexp_replace("rule", r"([\\.+?${}()\[\]])", r"\\$1")
    host = F.concat(F.lit("^(?:[^/]*\\.)?"), F.regexp_replace(
        F.regexp_replace("rule", r"([\\.+?${}()\[\]^|*])", r"\\$1"), "\n", "\\\\n"))
    body = F.regexp_replace(ascii_lower(escaped), r"^\|\|", "<label>")
    body = F.regexp_replace(F.regexp_replace(body, r"^\|", "<start>"), r"\|$", "<end>")
    body = F.regexp_replace(body, r"\|", r"\\|")
    body = F.regexp_replace(F.regexp_replace(body, r"\*", ".*"), r"\^", "(?:[^a-z0-9_.%-]|\\$)")
    body = F.regexp_replace(body, "^<label>", "^[^:/?#]*://(?:[^/?#]*\\\\.)?")
    body = F.regexp_replace(F.regexp_replace(body, "^<start>", "^"), "<end>$", "\\$")
    is_host = F.col("kind") == "host"
    # A token counts only if the rule itself bounds it on both sides.
    framed = F.when(is_host, F.concat(F.lit("."), F.col("rule"), F.lit("*"))).otherwise(
        F.concat(F.lit("*"), F.col("rule"), F.lit("*")))
    tokens = F.regexp_extract_all(ascii_lower(framed), F.lit("(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])"), 1)
    return (rules.where(F.col("rule").isNotNull()).dropDuplicates()
            .select("rule", "action", "kind",
                    F.concat(F.lit("(?s)"), F.when(is_host, host).otherwise(body)).alias("regex"),
                    F.array_distinct(tokens).alias("tokens")))


def url_parts(pages: DataFrame) -> DataFrame:
    """Distinct URLs with host, path and tokens."""
    url = F.col("url")
    return (pages.select("url").where(url.isNotNull()).distinct()
            .select("url", host_of(url).alias("host"), path_of(url).alias("path"),
                    F.array_union(F.array(F.lit("")),
                                  F.split(ascii_lower(url), "[^a-z0-9]+")).alias("tokens")))


def host_of(url):
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rarest_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """token, rule, action, kind, regex: each rule under its rarest token."""
    by_token = rules.select("*", F.explode_outer("tokens").alias("token"))
    held = (urls.select(F.explode("tokens").alias("token"))
            .join(by_token.select("token").distinct(), "token", "left_semi")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n_urls")))
    rank = F.struct(F.coalesce("n_urls", F.lit(0)).alias("n"), (-F.length("token")).alias("l"), "token")
    chosen = (by_token.join(held, "token", "left")
              .groupBy("rule", "action", "kind", "regex").agg(F.min(rank).alias("best")))
    return chosen.select(F.coalesce("best.token", F.lit("")).alias("token"),
                         "rule", "action", "kind", "regex")


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per input row: page_id, url, host, path, rule, verdict, pattern_rule."""
    urls = url_parts(pages)
    index = rarest_index(compile_rules(rules), urls)
    is_host = F.col("kind") == "host"
    subject = F.when(is_host, F.concat("host", "path")).otherwise(ascii_lower(F.col("url")))
    hits = (urls.select("url", "host", "path", F.explode("tokens").alias("token"))
            .join(index, "token")
            .where(F.regexp_like(subject, F.col("regex"))))
    best = F.struct(F.length("rule").alias("n"), "rule", "action")
    pattern = F.struct((F.col("action") == "allow").alias("allow"), F.length("rule").alias("n"), "rule", "action")
    verdicts = hits.groupBy("url").agg(
        F.max(F.when(is_host, best)).alias("by_host"),
        F.max(F.when(~is_host, pattern)).alias("by_pattern"))
    url = F.col("p.url")
    return (pages.select("page_id", "url").alias("p")
            .join(verdicts.alias("v"), url == F.col("v.url"), "left")
            .select("page_id", url.alias("url"),
                    F.coalesce(host_of(url), F.lit("")).alias("host"),
                    F.coalesce(path_of(url), F.lit("")).alias("path"),
                    F.col("by_host.rule").alias("rule"),
                    F.coalesce("by_host.action", "by_pattern.action", F.lit("allow")).alias("verdict"),
                    F.when(F.col("by_host").isNull(), F.col("by_pattern.rule")).alias("pattern_rule")))
