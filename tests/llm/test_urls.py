"""URL rules against brute force, row by row and rule by rule."""

import random

from pyspark.sql import functions as F

from tamis.llm import url_rules


def naive(url, rules):
    """rules: (tier, verdict, rule). Returns host, path, rule, own_rule, verdict."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut], rest[cut:].split("?")[0].split("#")[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for tier, verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if host and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((-tier, len(rule), len(h), rule, verdict == "block", verdict))
    if fits:
        tier, _, _, rule, _, verdict = max(fits)
        return host, path, rule if tier == 0 else None, rule if tier < 0 else None, verdict
    labels = host.replace("-", ".").replace("_", ".").split(".")
    return host, path, None, None, "block" if set(labels) & set(url_rules.WORDS) else "allow"


def compare(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for c in ("key", "stack", "at", "row", "host", "rule", "verdict", "part", "kind"):
        pages = pages.withColumn(c, F.lit("clash"))
    table = None
    for tier in sorted({r[0] for r in rules}):
        own = url_rules.rule_table(spark, tuple(r[1:] for r in rules if r[0] == tier), tier)
        table = own if table is None else table.unionByName(own)
    out = url_rules.judged(pages, table)
    assert {"key", "stack", "at", "row", "part", "kind"} < set(out.columns)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["own_rule"], r["verdict"]) for r in out.collect()}
    assert got == {k: naive(u, rules) for k, u in enumerate(urls)}


AWKWARD = [
    None, "", "no scheme", "http://", "https://org", "https://org/", "https://ORG/x", "HTTP://Example.ORG/es/1?a=/en/1#x", "http://example.org/en/1", "http://a.b.example.org/en/12#f", "http://example.org/es", "http://example.org:80/es/",
    "http://xexample.org/es/", "http://example.org./es/", "http://a..org/", "http://.org/", "http://x@y.com/fr/", "http://com/de/é", "http://q.com?u=http://z.org/", "http://É.com/fr/", "a://b://c.com/fr/", "http://casino-x.net/", "http://cheap.pills.info",
    "http://t.co/1", "http://x\ny.com/de/\n?z", "http://" + "a." * 120 + "org/" + "p/" * 3000,
]


def test_base_and_own_rules(spark):
    rules = [(0, *r) for r in url_rules.RULES] + [(1, *r) for r in url_rules.OWN_RULES]
    compare(spark, AWKWARD + AWKWARD[5:9] * 20, rules)


def test_nested_rules_at_random(spark):
    rng = random.Random(5)
    label = lambda: rng.choice("abc")
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 4)))
    path = lambda: rng.choice(["", "/"]) + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 4)))
    rules = []
    for _ in range(150):
        p = path()
        rules.append((rng.randint(0, 1), rng.choice(["allow", "block"]), host() + (p if p.startswith("/") or not p else "/" + p)))
    urls = [f"http://{host()}{p if (p := path()).startswith('/') or not p else '/' + p}" for _ in range(1_500)] + ["http://a.b.c/xy"] * 900
    compare(spark, urls, rules)


def test_tables_without_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = url_rules.rule_table(spark, url_rules.RULES)
    assert url_rules.judged(pages, rules).count() == 0
    some = spark.createDataFrame([(1, "http://spam.net/"), (2, "http://a.net/"), (2, None)], "page_id long, url string")
    assert sorted((r["page_id"], r["verdict"]) for r in url_rules.judged(some, rules.where("false")).collect()) == [(1, "block"), (2, "allow"), (2, "allow")]


def test_a_rule_needs_a_host(spark):
    for rule in (("block", "/x"), ("deny", "a.b/")):
        try:
            url_rules.rule_table(spark, (rule,))
        except ValueError:
            continue
        raise AssertionError(rule)
