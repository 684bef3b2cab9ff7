"""URL filters: host rules and patterns, looked up by their rarest literal token.

A rule is a host with the start of a path (``example.org/es/``); it fits the host and its subdomains.
A pattern is what ad blockers use: ``||`` is the start of the host or of one of its labels, ``|`` the
start or the end of the whole, ``^`` a separator or the end, ``*`` any characters, and everything else
stands for itself, letters in either case. Both become regular expressions over host and path.

Tokens are runs of A-Z, a-z and 0-9, lower-cased. A token that a rule or pattern holds whole, with a
literal separator or an anchor on either side, is in every URL that it fits. Each is filed under the
one of its whole tokens that the fewest distinct URLs hold; those without a whole token are filed under
the empty token, which all URLs have. Each distinct URL fetches what its tokens are filed under, by an
equi-join, and only those expressions are run on it.

Everything is DataFrame functions. URLs are judged once each and joined back, so repeated URLs cost one
judgement. Rules may be tables of any size: Spark broadcasts the index only if it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, unused

ALLOW, BLOCK = "allow", "block"

#: Fixed values of the query: host rules.
RULES = ((ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"))
#: Patterns for URLs that no host rule fits; of those that fit, the longest decides.
PATTERNS = (
    (BLOCK, "||adult-"), (BLOCK, "||casino-"), (BLOCK, "-bets."), (BLOCK, "||bet."), (BLOCK, "/porn/"), (BLOCK, "||ads."), (BLOCK, "/cgi-bin/"), (BLOCK, "/wp-login.php|"), (BLOCK, "viagra"),
    (ALLOW, "||casino-museum."), (ALLOW, "/adult-education^"),
)

_HOST, _PATH = r"://([^/?#]*)", r"://[^/?#]*([^?#]*)"
_TOKEN = "[a-z0-9]+"
#: A whole token has another literal character, or an anchor, on either side.
_WHOLE_IN_PATTERN = r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"
_SPECIAL = r"([\x00-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F])"
_LABEL = r"(?:[^/]*?\.)??"
_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\\z)"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def listed(spark: SparkSession, rules: tuple) -> DataFrame:
    """(action, rule) of a list of pairs."""
    if not rules:
        return spark.range(0).select(F.lit("").alias("action"), F.lit("").alias("rule"))
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(a).alias("action"), F.lit(r).alias("rule")) for a, r in rules])))


def _quoted(rule: Column) -> Column:
    return F.regexp_replace(rule, _SPECIAL, r"\\$1")


def host_rules(rules: DataFrame) -> DataFrame:
    """Rules (action, rule) with their expression, and whole tokens: the host's labels and those of the path but the last, which may go on."""
    named = rules.select("action", "rule").where("rule is not null and rule <> ''").distinct()
    return named.select("action", "rule", F.lit(True).alias("is_rule"), F.concat(F.lit(r"^(?:[^/]*\.)?"), _quoted(F.col("rule"))).alias("regex"), _whole(F.concat(F.lit("|"), F.col("rule"))).alias("tokens"))


def patterns(rules: DataFrame) -> DataFrame:
    """Patterns (action, rule) with their expression and whole tokens.

    Each part between two ``*`` takes its first place after the part before and is not tried again,
    which finds a fit if there is one and takes time in proportion to the URL.
    """
    named = rules.select("action", "rule").where("rule is not null and rule <> ''").distinct()
    body = _quoted(F.regexp_replace("rule", r"^\|{1,2}|\|$", ""))
    for mark, means in ((r"\\\*", ")(?>.*?"), (r"\\\^", _SEPARATOR)):
        body = F.regexp_replace(body, mark, means)
    first = F.when(F.col("rule").startswith("||"), _LABEL).when(F.col("rule").startswith("|"), "").otherwise(".*?")
    last = F.when(F.col("rule").rlike(r"[^|]\|$"), r"\z").otherwise("")
    regex = F.concat(F.lit("(?is)^(?>"), first, body, last, F.lit(")"))
    return named.select("action", "rule", F.lit(False).alias("is_rule"), regex.alias("regex"), _whole(F.col("rule")).alias("tokens"))


def _whole(rule: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(rule), F.lit(_WHOLE_IN_PATTERN), F.lit(0)))


def url_tokens(target: Column) -> Column:
    """The distinct tokens of a host and path, and the empty one."""
    return F.array_union(F.array(F.lit("")), F.regexp_extract_all(ascii_lower(target), F.lit(_TOKEN), F.lit(0)))


def rarest_token_index(compiled: DataFrame, urls: DataFrame) -> DataFrame:
    """(token, action, rule, is_rule, regex): each rule under its whole token that the fewest rows of ``urls`` hold, "" if it has none.

    Ties go to the longer token, then to the smaller one.
    """
    key = ["action", "rule", "is_rule", "regex"]
    held = compiled.select(*key, F.explode("tokens").alias("token"))
    seen = urls.select(F.explode(url_tokens(F.col("target"))).alias("token")).join(held.select("token").distinct(), "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count("*").alias("n"))
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.negative(F.length("token")).alias("shorter"), F.col("token").alias("token"))
    best = held.join(counts, "token", "left").groupBy(*key).agg(F.min(order)["token"].alias("token"))
    return best.unionByName(compiled.where(F.size("tokens") == 0).select(*key, F.lit("").alias("token"))).select("token", *key)


def fitting_rules(urls: DataFrame, index: DataFrame) -> DataFrame:
    """(url, by_rule, by_pattern): of the rules and of the patterns that fit each URL, the longest; URLs that none fits are left out.

    Of those of one length, that with the longer host decides (rules), then a blocking one, then the greater one.
    """
    fetched = urls.select("url", "target", F.explode(url_tokens(F.col("target"))).alias("token")).join(index, "token")
    fits = fetched.where(F.regexp_like("target", F.col("regex")))
    rank = F.struct(F.length("rule").alias("chars"), F.when(F.col("is_rule"), F.instr("rule", "/")).alias("host_chars"), (F.col("action") == BLOCK).alias("blocks"), F.col("rule").alias("rule"), F.col("action").alias("action"))
    return fits.groupBy("url").agg(F.max(F.when(F.col("is_rule"), rank)).alias("by_rule"), F.max(F.when(~F.col("is_rule"), rank)).alias("by_pattern"))


def judge_urls(pages: DataFrame, rules: DataFrame | None = None, pattern_rules: DataFrame | None = None, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` with the columns host, path, rule, pattern and verdict added.

    ``rules`` and ``pattern_rules`` are tables (action, rule), by default RULES and PATTERNS. ``rule``
    is the longest host rule that fits, and its action the verdict; where none fits, the longest
    pattern that fits decides (``pattern``, null where a rule decided), and where none does,
    ``default``. A path rule is compared as it is written, a host in lower case.

    Each row of ``pages`` gives one row. Null URLs and those without ``://`` have an empty host and
    path; URLs of any length are read whole. Repeated URLs are judged once and alike, whatever their
    rows' other columns hold. Added columns replace columns of the same names; other names pass.
    Repeated rules count once; null and empty ones fit nothing. Empty gives empty.
    """
    spark = pages.sparkSession
    rules = listed(spark, RULES) if rules is None else rules
    pattern_rules = listed(spark, PATTERNS) if pattern_rules is None else pattern_rules
    compiled = host_rules(rules).unionByName(patterns(pattern_rules))
    url = F.col(url_col)
    known = pages.select(url.alias("url")).where(F.col("url").isNotNull()).distinct()
    urls = materialize(known.select("url", F.concat(url_host(F.col("url")), url_path(F.col("url"))).alias("target")))
    judged = fitting_rules(urls, materialize(rarest_token_index(compiled, urls)))
    key, by_rule, by_pattern = unused(pages, "key", "by_rule", "by_pattern")
    joined = pages.join(judged.select(F.col("url").alias(key), F.col("by_rule").alias(by_rule), F.col("by_pattern").alias(by_pattern)), pages[url_col] == F.col(key), "left")
    rule, pattern = F.col(by_rule), F.when(F.col(by_rule).isNull(), F.col(by_pattern))
    added = {"host": url_host(url), "path": url_path(url), "rule": rule["rule"], "pattern": pattern["rule"], "verdict": F.coalesce(rule["action"], pattern["action"], F.lit(default))}
    taken = {c.lower() for c in added}
    return joined.select(*[pages[c] for c in pages.columns if c.lower() not in taken], *[v.alias(k) for k, v in added.items()])
