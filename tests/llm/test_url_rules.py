import random
import time

import pytest

from tableflow.llm import url_rules as U
from tests.llm.helpers import SF_SMALL

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def brute(url, rules=RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for action, rule in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or (0, "", ""), (len(rule), action, rule))
    tokens = host.replace("-", ".").split(".")
    verdict = best[1] if best else "block" if set(tokens) & set(U.BLOCKED_HOST_TOKENS) else "allow"
    return host, path, best[2] if best else None, verdict


URLS = [None, "", "no scheme", "http://", "://x.org/", "http://A.Example.ORG/es/1", "http://example.org/en/1", "http://example.org/en/2",
        "http://example.org", "http://example.org?x=/es/", "http://org/", "http://a.b.c.d.com/de/", "http://dexample.org/es/",
        "http://com/fr/#/de/", "https://u:p@x.com:80/de/", "http://x.com./de/", "http://free-bets.example.net/a", "http://bets/",
        "http://alphabets.net/", "http://x.net/http://y.org/es/", "a://b://c.org/", "http://É.org/", "http://..com/de/",
        "http://" + "a." * 5000 + "org/" + "x/" * 5000, "x" * 100_000, "http://x.org/\nes/"]


def test_matches_brute_force(spark):
    df = spark.createDataFrame([(k, u, "h", 1) for k, u in enumerate(URLS)], "page_id long, url string, host string, _row long")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, U.rule_table(spark, RULES)).collect()}
    assert got == {k: brute(u) for k, u in enumerate(URLS)}


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(pages, U.rule_table(spark, RULES)).collect()}
    assert got == {r.page_id: brute(r.url) for r in pages.collect()}


def test_no_rules_empty_tables_repeated_rows_null_ids(spark):
    df = spark.createDataFrame([(None, "http://x.org/es/"), (1, "http://x.org/es/"), (1, "http://x.org/es/"), (2, None)],
                               "page_id long, url string")
    none = U.rule_table(spark, [("allow", "org/")]).limit(0)
    assert [r.rule for r in U.judge(df, none).collect()] == [None] * 4
    rules = U.rule_table(spark, [("allow", "org/"), ("block", "org/")])
    assert sorted(r.verdict for r in U.judge(df, rules).collect()) == ["allow", "block", "block", "block"]
    assert U.judge(df.limit(0), rules).count() == 0


@pytest.mark.parametrize("rules", [[("block", "a.b.c.example.org/"), ("allow", "example.org/")], [("block", "x.com/a/b/c"), ("allow", "x.com/a")]])
def test_longest_rule_wins(spark, rules):
    urls = ["http://z.a.b.c.example.org/", "http://b.c.example.org/", "http://x.com/a/b/cd", "http://x.com/a/b/", "http://y.x.com/ab"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(df, U.rule_table(spark, rules)).collect()}
    assert got == {k: brute(u, rules) for k, u in enumerate(urls)}


def test_many_rules_of_many_lengths(spark):
    """Ten thousand rules with 300 path lengths: one plan, and a third of the pages share an expression."""
    rng = random.Random(4)
    rules = [(rng.choice(["allow", "block"]), f"h{rng.randint(0, 99)}.{rng.choice(['org', 'co.uk'])}/" + "p" * rng.randint(0, 299) + str(k % 10))
             for k in range(10_000)] + [("allow", "net/")]
    urls = [f"http://{rng.choice(['', 'www.'])}h{rng.randint(0, 120)}.{rng.choice(['org', 'co.uk'])}/" + "p" * rng.randint(0, 320)
            + rng.choice("0123456789") + "/x" for _ in range(200)] + [f"http://{k}.poker.net/{k}" for k in range(100)]
    rules_df, pages = U.rule_table(spark, rules), spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    began = time.monotonic()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(pages, rules_df).collect()}
    assert time.monotonic() - began < 30
    assert got == {k: brute(u, rules) for k, u in enumerate(urls)}
    assert U._lengths(rules_df)[2][:3] == [1, 2, 3] or len(U._lengths(rules_df)[2]) > 200


def test_hot_expressions_are_spread_when_rules_are_not_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        urls = [f"http://w{k}.org/es/" for k in range(300)] + [None, "http://casino.example.net/"]
        df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        out = U.judge(df, U.rule_table(spark, RULES))
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()} == {k: brute(u) for k, u in enumerate(urls)}
        assert "_salt" in out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
