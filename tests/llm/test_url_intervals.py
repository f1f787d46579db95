import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.url_intervals import judged, judged_pages

RULES = [
    ("com", "/", "allow"),
    ("Example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "", "allow"),
    ("a.net", "/es/x", "allow"),
    ("", "/none", "block"),
    ("example.com", "/en/deep/er", "allow"),
    ("org", "/" + "p" * 3000, "block"),
]


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fit = []
    for h, p, verdict in rules:
        h = h.lower()
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h) + len(p), len(h), h + p, verdict))
    return (host, path, max(fit)[2], max(fit)[3]) if fit else (host, path, None, default)


def urls():
    rng = random.Random(3)
    out = [None, "", "no scheme", "x://", "x:///none", "http://a://b/en/", "http://EXAMPLE.com/EN/", "http://com", "http://com/"]
    out += ["http://\u00c4.com/en/", "http://xcom/en/", "http://.com/x", "http://com./x", "http://a.b.c.d.e.com/#/x", "http://com:80/en/"]
    out += ["http://example.com?/en/", "http://example.com/en/deep/er/x", "http://" + "l." * 20_000 + "net/es/1"]
    out += ["http://x.org/" + "p" * 5000, "http://x.org/" + "p" * 2999, "http://" + "h" * 100_000 + ".com/en/"]
    for _ in range(400):
        host = ".".join(rng.choices(["www", "a", "b", "example", "m"], k=rng.randrange(4)) + [rng.choice(["com", "net", "example.com"])])
        out.append(f"http://{host.lstrip('.')}/{rng.choice(['en', 'es', 'fr'])}/{rng.choice(['x', 'deep/er', ''])}{rng.choice(['', '?q=/', '#f'])}")
    return out + out[-50:]


@pytest.mark.parametrize("per_range", [500_000, 40])
def test_equals_every_rule_against_every_url(spark, per_range):
    given = urls()
    rows = spark.createDataFrame([(i, u, i, "c") for i, u in enumerate(given)], "page_id long, url string, row long, host string")
    rules = spark.createDataFrame(RULES + RULES[:2], "host string, path string, verdict string").repartition(3)
    got = judged(rows.repartition(5), rules, per_range=per_range, least_ranges=3)
    got = {r.doc.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert got == {i: plain(u, RULES) for i, u in enumerate(given)}


def test_odd_rules_and_empty_tables(spark):
    pages = spark.createDataFrame([(None, "http://a.com/x"), (1, None), (1, None)], "page_id long, url string")
    rules = [(None, "/", "block"), ("com", None, "block"), ("com", "", "allow"), ("a.com", "/x", "maybe")]
    got = sorted(judged_pages(pages, rules).collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "", "", None, "allow")] * 2 + [(None, "a.com", "/x", "com", "block")]
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in judged(pages, none, default="block").collect()} == {"block"}
    assert judged_pages(pages.where(F.lit(False)), rules).count() == 0
