import random

import pytest

from tessera.llm import url_filters
from tessera.llm.url_filters import RULES, url_filter

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(s, marks):
    return s[:min([s.find(m) for m in marks if m in s], default=len(s))]


def brute(url, rules, unlisted="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = cut(rest, "/?#")
    path, host = cut(rest[len(host):], "?#"), host.translate(LOW)
    fit = [(len(h + p), len(h), v == "block", h + p) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], unlisted if best is None else "block" if best[2] else "allow"


def judged(spark, urls, rules, **kw):
    pages = spark.createDataFrame([(i, u, "clash", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, key string")
    r = spark.createDataFrame([(*x, "clash") for x in rules], "host string, path string, verdict string, labels string")
    out = {row.page_id: tuple(row)[1:] for row in url_filter(pages, r, **kw).collect()}
    assert len(out) == len(urls)
    return [out[i] for i in range(len(urls))]


ODD = [None, "", "no scheme", "://", "http://", "http://com", "http://com/", "http://.com/", "HTTP://WWW.EXAMPLE.COM/en/1",
       "http://a.www.example.com/en/x?y#z", "http://xexample.com/en/", "http://example.com/EN/", "http://example.com?x/en/",
       "http://example.com#/en/", "http://u@example.com:80/en/", "http://ÄB.example.net/fr/é", "a://b://net/es/", "http://x.net/es",
       "http://x.net/es/" + "p" * 300_000, "http://" + "a." * 20_000 + "net/fr/", "http://a..com//", "http://é\n.com/\n?"]


def test_rules_of_the_query_equal_brute_force(spark):
    urls = ODD + ODD
    assert judged(spark, urls, RULES) == [brute(u, RULES) for u in urls]


@pytest.mark.parametrize("bits,part", [(12, 1 << 25), (2, 1 << 25), (3, 256)])
def test_many_rules_with_poor_filters_and_several_parts_stay_exact(spark, monkeypatch, bits, part):
    """Two bits a key give many false positives, so the cascade needs many levels; 256 bits need several parts."""
    monkeypatch.setattr(url_filters, "BITS_PER_KEY", bits)
    monkeypatch.setattr(url_filters, "PART_BITS", part)
    rng = random.Random(5)
    hosts = [".".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(60)]
    paths = ["", "/", "/x", "/x/", "/x/y", "/z"]
    rules = list({(rng.choice(hosts), rng.choice(paths)): rng.choice(["block", "allow"]) for _ in range(150)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"s://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'q', '/x/y/z', '?x'])}" for _ in range(1500)]
    assert judged(spark, urls, rules, unlisted="block") == [brute(u, rules, "block") for u in urls]


def test_edge_rules(spark):
    assert judged(spark, ["http://a.com/"], []) == [("a.com", "/", None, "allow")]
    both = [("COM", None, "block"), ("com", "", "allow"), (None, "/q", "block")]
    assert judged(spark, ["http://a.com/q", "http:///q", "x"], both) == [
        ("a.com", "/q", "com", "block"), ("", "/q", "/q", "block"), ("", "", None, "allow")]
    assert url_filter(spark.createDataFrame([], "page_id long, url string"),
                      spark.createDataFrame(RULES, "host string, path string, verdict string")).collect() == []
    with pytest.raises(ValueError):
        judged(spark, ["http://a.com/"], [("com", "/", None)])


def test_judging_neither_joins_nor_shuffles(spark, capsys):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = url_filter(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    out.explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan
