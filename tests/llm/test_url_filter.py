"""URL verdicts against plain Python, and tokens against the expressions they stand for."""

import random
import re

import pytest
from pyspark.sql import functions as F

from helixframe.llm import url_filter as U

PAGES = "page_id long, url string, html string, rule string, `__key` long, token string"


def brute(url, rules=U.RULES, patterns=U.PATTERNS):
    """(host, path, rule, pattern, verdict)."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, path = rest[:end], re.split("[?#]", rest[end:])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for action, rule in rules:
        own, start = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == own or host.endswith("." + own)) and path.startswith(start) and (best is None or len(rule) > len(best[1])):
            best = (action, rule)
    if best:
        return host, path, best[1], None, best[0]
    fits = []
    for action, pattern in patterns:
        body = pattern
        lead = r"\A(?:[^/]*\.)?" if body.startswith("||") else r"\A" if body.startswith("|") else ""
        body = body.lstrip("|")
        tail = r"\Z" if body.endswith("|") else ""
        body = body.rstrip("|")
        inner = "".join(".*" if c == "*" else r"(?:[^A-Za-z0-9_.%-]|\Z)" if c == "^" else re.escape(c) for c in body)
        if re.search(lead + inner + tail, host + path, re.IGNORECASE | re.DOTALL | re.ASCII):
            fits.append((len(pattern), action == "block", pattern, action))
    if fits:
        best = max(fits)
        return host, path, None, best[2], best[3]
    return host, path, None, None, "allow"


def urls():
    rng = random.Random(4)
    hosts = ["example.org", "www.EXAMPLE.org", "xexample.org", "a.com", "com", "b.net", "adult-x.b.net", "casino-win.b.net", "casino-museum.b.net", "free-bets.b.net", "bet.b.net", "notadult-x.b.net", "user@a.com:80", "é.com", "org", ""]
    paths = ["", "/", "/es/", "/en/1", "/en/12/x", "/EN/1", "/en/2", "/fr/", "/fr", "/de/7.html", "/wp-login.php", "/wp-login.php/x", "/cgi-bin/q", "/adult-education", "/adult-education/x", "/adult-educational", "/VIAGRA-x", "/a/b/porn/c", "/日本"]
    tails = ["", "?q=/de/", "#viagra", "?x#y", "?u=http://org/"]
    made = [f"{rng.choice(['http', 'https', 'x'])}://{h}{p}{rng.choice(tails)}" for h in hosts for p in paths]
    return [*made, None, "", "no scheme", "example.org/es/", "://", "http://", "http://a.b/line\nbreak/porn/", *made[:3]]


def test_verdicts_against_plain_python(spark):
    rows = [(i if i % 9 else None, u, "<p>", "r", i, None) for i, u in enumerate(urls())]
    found = U.judge_urls(spark.createDataFrame(rows, PAGES))
    assert found.columns == ["page_id", "url", "html", "__key", "token", "host", "path", "rule", "pattern", "verdict"]
    got = sorted(((r["__key"], r["host"], r["path"], r["rule"], r["pattern"], r["verdict"]) for r in found.collect()), key=repr)
    assert got == sorted(((i, *brute(u)) for i, u in enumerate(urls())), key=repr)


def test_other_rules(spark):
    rng = random.Random(7)
    parts = ["||", "|", "^", "*", ".", "-", "/", "org", "com", "example", "en", "1", "x", "a.b", "[", "$", "\\", "é", "EN"]
    patterns = {(rng.choice(["allow", "block"]), "".join(rng.choice(parts) for _ in range(rng.randrange(1, 5)))) for _ in range(120)}
    # Bars that are no anchors are left to the query.
    patterns = sorted(p for p in patterns if "|" not in p[1].strip("|") and p[1].strip("|") and not p[1].startswith("|||") and not p[1].endswith("||"))
    rules = [("block", "example.org/"), ("block", "example.org/"), ("allow", "www.example.org/es"), ("block", "b.net/wp-login.php")]
    named = sorted(set(urls()) - {None})[::3]
    got = U.judge_urls(spark.createDataFrame([(u,) for u in named], "url string"), U.listed(spark, tuple(rules)), U.listed(spark, tuple(patterns)))
    for r in got.collect():
        want = brute(r["url"], rules, patterns)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (want[0], want[1], want[2], want[4]), (r, want)


def test_only_candidates_meet_expressions(spark):
    pages = spark.createDataFrame([("http://a.example.org/es/",), ("http://b.net/",), ("http://c.org/x",)], "url string")
    known = pages.select("url", F.concat(U.url_host(F.col("url")), U.url_path(F.col("url"))).alias("target"))
    index = {r["rule"]: r["token"] for r in U.rarest_token_index(U.host_rules(U.listed(spark, U.RULES)).unionByName(U.patterns(U.listed(spark, U.PATTERNS))), known).collect()}
    assert index["org/"] == "org" and index["example.org/es/"] == "example" and index["com/de/"] == "com" and index["viagra"] == "" and index["||casino-museum."] == "casino"


def test_long_urls(spark):
    rules = (("block", "/*/*/*x"), ("block", "||*q*w*"), ("block", "z*z*z^q|"))
    pages = spark.createDataFrame([("http://a.com/" + "z/" * 50_000,), ("http://a.com/" + "z/" * 50_000 + "q",), ("http://" + "h." * 50_000 + "org/en",)], "url string")
    found = {(r["host"][:2], r["path"][-2:]): (r["rule"], r["pattern"]) for r in U.judge_urls(pages, pattern_rules=U.listed(spark, rules)).collect()}
    assert found == {("a.", "z/"): (None, None), ("a.", "/q"): (None, "z*z*z^q|"), ("h.", "en"): ("org/", None)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], PAGES)
    assert U.judge_urls(none).collect() == []
    pages = spark.createDataFrame([("http://org/",)], "url string")
    (r,) = U.judge_urls(pages, U.listed(spark, ()), U.listed(spark, ())).collect()
    assert (r["rule"], r["pattern"], r["verdict"]) == (None, None, "allow")
    (r,) = U.judge_urls(pages, spark.createDataFrame([(None, None), ("block", ""), ("block", "org/")], "action string, rule string")).collect()
    assert (r["rule"], r["verdict"]) == ("org/", "block")


def test_no_python_on_the_main_path(spark):
    plan = U.judge_urls(spark.createDataFrame([("http://org/",)], "url string").repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("ArrowEval|MapInArrow|MapInPandas|BatchEval|FlatMapGroups", plan)
