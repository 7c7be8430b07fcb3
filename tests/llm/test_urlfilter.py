import pytest

from textloom.llm import urlfilter

CASES = ["http://A.Example.com/en/71?x", "https://net/de/8", "ftp://x.example.net/de/8#f", "http://notexample.com/en/7", "no scheme", None, "", "://", "http://b.org/es/", "http://b.org/es", "http://www.cheap-pills.example.com/", "http://xcheap-pills.example.com/", "http://a..com/en/?", "HTTP://É.COM/en/", "a://b://c.com/en/"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    under = lambda name: host == name or host.endswith("." + name)
    best = max((r for r in urlfilter.RULES if under(r[1].split("/")[0]) and path.startswith("/" + r[1].partition("/")[2])), key=lambda r: len(r[1]), default=None)
    return host, path, best and best[1], best[0] if best else "block" if any(map(under, urlfilter.LISTED_HOSTS)) else "allow"


def test_cases(spark):
    rows = [(i, u, None) for i, u in enumerate(CASES * 2)] + [(None, "http://a.com/en/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    want = sorted((str(i), *plain(u)) for i, u, _ in rows)
    key = lambda t: tuple(map(str, t))
    assert sorted(((str(r[0]), *r[1:]) for r in urlfilter.judge(pages).collect()), key=key) == sorted(want, key=key)
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_cascade_is_exact_and_bounded(spark, monkeypatch):
    universe = spark.range(4000).selectExpr("concat('k', id) AS key")
    listed = universe.filter("hash(key) % 9 = 0")
    cascade = urlfilter.build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    got = {r.key for r in universe.filter(cascade.has(universe.key)).collect()}
    assert got == {r.key for r in listed.collect()}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(CASES)], "page_id long, url string")
    monkeypatch.setattr(urlfilter, "MAX_LEVEL_BITS", 1)
    with pytest.raises(ValueError, match="split the list"):
        urlfilter.judge(pages)
