import random
import re

import fixtures as X
from oracle_check import connect, differences

from hydrolens.llm import url_rules as U
from hydrolens.sources.folders import RunFolder

PAGES = "page_id long, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    tail = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", tail)[0]
    return X.ascii_lower(host), re.match(r"[^?#]*", tail[len(host) :])[0]


def brute(urls, rules, default=U.ALLOW):
    out = []
    for key, url in urls:
        host, path = split(url)
        fitting = [
            (len(h + p), len(h), h + p, v)
            for h, p, v in ((h and X.ascii_lower(h), p, v) for h, p, v in rules)
            if h is not None and p is not None and v in (U.BLOCK, U.ALLOW)
            and (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fitting, default=None)
        out.append((key, host, path, best[2] if best else None, best[3] if best else default))
    return sorted(out, key=str)


AWKWARD = [
    None, "", "no url", "://", "http://", "http://x.net", "http://x.net/", "HTTP://WWW.X.Net/a?b=/en/", "http://example.net/en/1",
    "http://a.b.example.net/en", "http://example.net/en?x", "http://notexample.net/en/", "http://example.com/de/#x/y", "http://example.com/DE/",
    "http://org/fr/a/b/c", "http://x.org/fr", "x://y://z.net/", "http://net/", "http://.net/a", "http://net./a", "http://a..net//", "http://a.net?/x",
    "http://u:p@x.net:80/", "http://x.net:80/", "http://É.net/é/", "http://x.net/\n/a", "http://\n.net/a",
    "http://" + "a." * 30_000 + "net/" + "b/" * 30_000, "http://x.org/fr/" + "é" * 2_000_000,
]


def pages_of(spark, urls, start=0):
    return spark.createDataFrame([(start + i, u, "<p>") for i, u in enumerate(urls)], PAGES)


def test_registered_rules(spark, tmp_path):
    urls = AWKWARD + ["http://x.net/a"] * 50
    folder = X.folder_of(tmp_path, pages=pages_of(spark, urls))
    result = U.page_verdicts(spark, folder)
    wanted = brute(enumerate(urls), U.RULES)
    assert sorted(map(tuple, result.collect()), key=str) == wanted
    assert {w[3] for w in wanted} == {None, "net/", "example.net/en/", "example.com/de/", "org/fr/"}
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
    assert differences(result, connect(folder), U.VERDICTS_SQL) == ""


def test_random_rules_of_any_shape(spark, monkeypatch):
    """Paths that end anywhere, short digest prefixes that clash, no broadcasts."""
    monkeypatch.setattr(U, "PREFIX", 1)
    monkeypatch.setattr(U, "small", lambda df: df)
    rng = random.Random(12)

    def host():
        return ".".join(rng.choice(["a", "b", "net", "ab"]) for _ in range(rng.randrange(1, 5)))

    def path():
        return "".join(rng.choice(["/", "/x", "x", "/xy", "y"]) for _ in range(rng.randrange(5)))

    rules = [(host().upper(), path(), rng.choice([U.BLOCK, U.ALLOW])) for _ in range(120)]
    rules = list({(X.ascii_lower(h), p): (h, p, v) for h, p, v in rules}.values())
    rules += [(None, "/", U.BLOCK), ("a", None, U.BLOCK), ("a", "/", None), ("b", "/", "maybe")]
    urls = [f"http://{host()}/{path()}" for _ in range(300)] + AWKWARD[:-2]
    frame = spark.createDataFrame(rules, U.RULE_SCHEMA)
    rows = U.judged(pages_of(spark, urls), "url", frame, RunFolder(spark), U.BLOCK).select("page_id", "host", "path", "rule", "verdict").collect()
    wanted = brute(enumerate(urls), rules, U.BLOCK)
    assert sorted(map(tuple, rows), key=str) == wanted
    assert sum(w[3] is not None for w in wanted) > 50


def test_equal_rules_block(spark):
    frame = spark.createDataFrame([("net", "/", U.ALLOW), ("NET", "/", U.BLOCK)], U.RULE_SCHEMA)
    rows = U.judged(pages_of(spark, ["http://a.net/"]), "url", frame, RunFolder(spark)).collect()
    assert [(r.rule, r.verdict) for r in rows] == [("net/", U.BLOCK)]


def test_empty_tables_repeated_rows_and_names(spark):
    rules = spark.createDataFrame(list(U.RULES), U.RULE_SCHEMA)
    pages = spark.createDataFrame([(None, "http://a.net/"), (None, "http://a.net/"), (3, None)], "page_id long, url string")
    named = pages.selectExpr("*", "'x' as host", "'x' as Rule", "1 as digest", "2 as prefix", "3 as shape", "4 as row", "5 as `a.b`")
    rows = U.judged(named, "url", rules, RunFolder(spark))
    assert rows.columns == ["page_id", "url", "digest", "prefix", "shape", "row", "a.b", "host", "path", "rule", "verdict"]
    assert sorted((str(r.page_id), r.verdict, r.row) for r in rows.collect()) == [("3", "allow", 4), ("None", "block", 4), ("None", "block", 4)]
    assert U.judged(pages.limit(0), "url", rules, RunFolder(spark)).collect() == []
    assert {r.verdict for r in U.judged(pages, "url", rules.limit(0), RunFolder(spark)).collect()} == {"allow"}


def test_too_many_shapes_are_refused(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(U, "SHAPES", 1)
    rules = spark.createDataFrame(list(U.RULES), U.RULE_SCHEMA)
    with pytest.raises(ValueError, match="shapes"):
        U.judged(pages_of(spark, ["http://a.net/"]), "url", rules, RunFolder(spark))
