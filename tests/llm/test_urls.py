import random
import re

from tillmart.llm import urls

SCHEMA = "page_id long, url string, html string, URL_ string, score double, features string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, "h", "x", 0.1, "f") for i, u in rows], SCHEMA)


def brute(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, v) for h, p, v in urls.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "://A.Org/x", "https://EXAMPLE.org/es/1?x#y", "http://m.example.org/en/15",
        "http://notexample.org/es/", "http://example.org", "http://example.org?/es/", "ftp://a.com/fr/", "x://com/de/#",
        "http://a.com/de", "http://Ñ.ORG/", "http://a.org/b://c.com/fr/", "http://a.net/en/1?u=x://b.org/"]


def test_rules(spark):
    got = {r["page_id"]: r for r in urls.filter_urls(table(spark, enumerate(URLS))).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, (rule, verdict) = brute(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == (verdict or got[i]["verdict"]) in ("allow", "block")


def test_trees_learn_lexical_features(spark):
    """Blocked URLs are long and full of digits; the trees carry that over to other hosts."""
    rng = random.Random(2)

    def url(host, bad):
        tail = "".join(rng.choices("0123456789", k=40)) if bad else "page"
        return f"http://{host}/{'de' if bad else 'fr'}/{tail}"

    rows = [(i, url(f"h{i % 9}.com", i % 2)) for i in range(400)]
    rows += [(1000 + i, url(f"h{i % 9}.net", i % 2)) for i in range(200)]
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(table(spark, rows)).collect()}
    assert all(got[1000 + i] == ("block" if i % 2 else "allow") for i in range(200))


def test_a_rare_class_is_learned(spark, monkeypatch):
    """Three blocked URLs in 1,803, two thirds of all rows one allowed URL, a sample of 40 a class."""
    monkeypatch.setattr(urls, "SAMPLE", 40)
    tail = "0123456789" * 4
    rows = [(i, f"http://h{i % 9}.com/fr/page{'x' * (i % 50)}/{i % 7}") for i in range(1800)]
    rows += [(2000 + i, "http://hot.com/fr/page") for i in range(3600)]
    rows += [(6000 + i, f"http://h{i}.com/de/{tail}{i}") for i in range(3)]
    rows += [(7000, f"http://h4.net/zz/{tail}7"), (7001, "http://h4.net/zz/pagexxx/2")]
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert (got[7000], got[7001]) == ("block", "allow")


def test_one_class_and_empty(spark):
    rows = [(1, "http://a.org/x"), (2, "http://b.net/y"), (2, "http://b.net/y"), (None, None)]
    assert {r["verdict"] for r in urls.filter_urls(table(spark, rows)).collect()} == {"allow"}
    assert urls.filter_urls(table(spark, [])).collect() == []
