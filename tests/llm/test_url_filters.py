"""URL rules: the index against trying every rule, and against SQL."""

from __future__ import annotations

import random
import re

from leaseflow.llm import queries as Q
from leaseflow.llm import url_filters as U
from tests.conftest import SMALL
from tests.oracle_compare import compare, connect

SCHEMA = "page_id bigint, url string, host string, rule int"


def test_split_url():
    assert U.split_url("HTTP://WWW.É.Org:80/A/b?c#d") == ("www.É.org:80", "/A/b")
    assert U.split_url("http://a.b?x/y") == ("a.b", "")
    assert U.split_url("http://a://b/c") == ("a:", "//b/c")
    for url in (None, "", "no scheme", "a:/b"):
        assert U.split_url(url) == ("", "")


def test_index_equals_trying_all_rules():
    rng = random.Random(1)
    labels, steps = ["a", "b", "shop", "x-y", "org"], ["en", "1", "12", "a.b", "Z", ""]
    rules = [U.host_rule(rng.choice(("allow", "block")), ".".join(rng.choice(labels) for _ in range(
        rng.randrange(1, 4))) + "/" + "/".join(rng.choice(steps) for _ in range(rng.randrange(3))))
        for _ in range(60)]
    rules += [U.wildcard_rule("block", p) for p in ("/a*b", "x-y^", "*", ".a.", "shop", "/en/1^", "é.org")]
    for counts in ({}, {b"a": 9, b"org": 5, b"shop": 1}):
        index = U.Index(rules, counts)
        for _ in range(1500):
            url = "http://" + ".".join(rng.choice(labels) for _ in range(rng.randrange(5))) + "/" + "/".join(
                rng.choice([*steps, "é", "K"]) for _ in range(rng.randrange(4)))
            target = "".join(U.split_url(url))
            fits = [(r.listed, len(r.name), -k, r.name) for k, r in enumerate(rules) if re.search(r.pattern, target, re.S)]
            best = index.best(target)
            assert (best.name if best else None) == (max(fits)[3] if fits else None), url


def test_hosts_and_path_prefixes():
    rules = [U.host_rule(v, r) for v, r in Q.URL_RULES]
    index = U.Index(rules, {})
    for url, want in {
        "http://example.org/en/1": "example.org/en/1", "http://a.example.org/en/12?q": "example.org/en/1",
        "http://badexample.org/es/": "org/", "http://example.org/ES/": "org/", "http://org/x": "org/",
        "http://x.org": None, "http://x.org:80/": None, "http://x.com/fr/1": "com/fr/",
        "http://x.com/de": None, "http://xorg/": None,
    }.items():
        best = index.best("".join(U.split_url(url)))
        assert (best.name if best else None) == want, url


def test_only_candidates_run():
    index = U.Index([U.host_rule("block", f"site{i}.net/") for i in range(1000)], {b"net": 10**6})
    assert len(index.candidates("www.site7.net/x")) == 1 and not index.candidates("other.net/")


def test_edge_cases(spark):
    rows = [(1, None), (1, ""), (None, "http://A.Example.ORG/es/x"), (3, "http://a.net/\n/.iso"), (3, "http://a.net/\n/.iso"),
            (4, "://"), (5, "x" * 100_000 + "://y.org/")]
    pages = spark.createDataFrame([(i, u, "h", 0) for i, u in rows], SCHEMA)
    rules = [*[U.host_rule(v, r) for v, r in Q.URL_RULES], *U.PATTERNS]
    got = [(r.page_id, r.host, r.rule, r.verdict) for r in U.judge(pages, rules).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "", None, "allow"), (1, "", None, "allow"), (None, "a.example.org", "example.org/es/", "block"),
        (3, "a.net", None, "block"), (3, "a.net", None, "block"), (4, "", None, "allow"),
        (5, "y.org", "org/", "allow")], key=str)
    assert {r.verdict for r in U.judge(pages, []).collect()} == {"allow"}
    assert U.judge(pages.limit(0), rules).count() == 0


def test_query_equals_sql(spark):
    rows, _, problem = compare(Q.QUERIES["op7_url_filters"](spark, SMALL), connect(SMALL),
                               Q.ORACLE["op7_url_filters"])
    assert rows and not problem
