import re

import pytest

from minutelake.llm import url_filters as uf

URLS = [None, "", "no scheme", "http://", "HTTP://A.ORG", "http://a.org/", "http://a.org?x=/", "http://EXAMPLE.org/es/1", "http://x.example.org/en/12", "http://x.example.org/en/2", "http://badexample.org/es/", "http://b.com/fr/", "http://b.com/de", "http://b.com/de/x#/fr/", "http://c.net/de/", "http://org/", "http://com:80/de/", "a://b://c.org/", "http://ÀB.org/", "ftp://q.com?/de/", "http://d.com/en/?a=1&b=2#z", "http://e.com/fr/" + "9" * 5000]


def brute(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_parts_and_rules(spark, tmp_path):
    rows = [(i, u, "h", "v") for i, u in enumerate(URLS * 2)] + [(None, URLS[5], "h", "v"), (3, URLS[3], "h", "v")]
    spark.createDataFrame(rows, "page_id long, url string, host string, verdict string").write.parquet(f"{tmp_path}/pages.parquet")
    found = uf.op6_url_filters(spark, str(tmp_path))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    out = sorted((tuple(r) for r in found.collect()), key=repr)
    assert [r[:4] for r in out] == [r for r in sorted(((i, *brute(u)[:3]) for i, u, *_ in rows), key=repr)]
    by_url = {}
    for i, host, path, rule, verdict in out:
        assert verdict in ("allow", "block")
        if rule:
            assert verdict == next(r.verdict for r in uf.RULES if r.text == rule)
        elif i is not None:
            assert by_url.setdefault(URLS[i % len(URLS)], verdict) == verdict


def test_trees_learn_from_labelled_urls(spark):
    """Held out: the URLs of hosts without a rule, whose first segment tells what the rules do elsewhere."""
    rows = [(i, f"http://h{i % 51}.com/{seg}/{i}") for i in range(900) for seg in (("fr", "de")[i % 2],)]
    held = [(10_000 + i, f"http://k{i}.net/{('fr', 'de')[i % 2]}/{i}") for i in range(200)]
    found = uf.url_filter(spark, spark.createDataFrame(rows + held, "page_id long, url string"))
    right = [(r["verdict"] == "block") == ("/de/" in r["url"]) for r in found.where("rule IS NULL").collect()]
    assert len(right) == 200 and sum(right) > 190


@pytest.mark.parametrize(("urls", "verdict"), [(["http://a.net/x", None], "allow"), (["http://a.com/de/", "http://z.net/"], "block"), (["http://a.org/", "http://z.net/"], "allow")])
def test_labels_of_one_kind_or_none(spark, urls, verdict):
    found = uf.url_filter(spark, spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string"))
    assert {r["verdict"] for r in found.where("rule IS NULL").collect()} == {verdict}


def test_no_urls(spark):
    assert uf.url_filter(spark, spark.createDataFrame([], "page_id long, url string")).count() == 0
