import re

import pytest

from cubeguard.llm import url_filter as U

SCHEMA = "page_id long, url string, html string, host string, template string"


def frame(spark, urls):
    return spark.createDataFrame([(k, u, None, "clash", "clash") for k, u in enumerate(urls)], SCHEMA)


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1].translate(str.maketrans(U._UPPER, U._UPPER.lower())), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://A.Com", "http://a.com/", "https://WWW.EXAMPLE.com/en/1?x=/en/", "http://b.example.com/en/", "http://b.example.com/en", "http://example.com/en/x", "http://x.www.example.com/en/1",
        "ftp://n.NET/es/2#a", "http://net/fr/", "http://notnet/fr/", "http://a.org?u=http://b.com/", "x://y://z/", "http://ÄB.net/es/é", "http://a.org//x//y/", "http://h.com#/en/", "http://a.org/a\nb?c", "http://é.example.com/en/1"]


def test_rules_by_brute_force(spark):
    for r in U.judged(frame(spark, URLS)).collect():
        host, path, (rule, verdict) = brute(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


RULES = (("block", "site.org", "/spam/1"), ("allow", "site.org", "/news/ok"))


@pytest.fixture(scope="module")
def verdicts(spark):
    urls = [f"http://site.org/spam/1{k}.html" for k in range(40)] + [f"http://site.org/spam/2{k}.html" for k in range(5)]
    urls += [f"http://site.org/news/ok{k}" for k in range(40)] + [f"http://site.org/news/n{k}" for k in range(5)]
    urls += [f"http://site.org/blog/ok/{k}" for k in range(30)] + [f"http://site.org/{k}/a" for k in range(30)] + [f"http://other.org/spam/2{k}.html" for k in range(9)]
    return {urls[r.page_id]: r for r in U.judged(frame(spark, urls), RULES).collect()}


def test_template_is_rejected_by_its_labels(verdicts):
    assert all(r.verdict == "block" and r.rule is None for u, r in verdicts.items() if u.startswith("http://site.org/spam/2"))
    assert all(r.verdict == "allow" for u, r in verdicts.items() if "/news/" in u or "/blog/" in u or "other.org" in u)


def test_variable_segments_become_wildcards(verdicts):
    assert {r.template for u, r in verdicts.items() if "/site.org/blog/" in u} == {"/blog/ok/{n}"}
    assert {r.template for u, r in verdicts.items() if re.search(r"site.org/\d", u)} == {"/{n}/a"}


def test_similar_branches_are_merged_and_others_not(spark):
    rules = (("block", "a.org", "/de/b"), ("block", "a.org", "/fr/b"), ("allow", "a.org", "/en/b"))
    urls = [f"http://a.org/{lang}/b{k}" for lang in ("de", "fr", "en") for k in range(30)]
    got = {urls[r.page_id]: r.template for r in U.judged(frame(spark, urls), rules).collect()}
    assert got["http://a.org/de/b1"] == got["http://a.org/fr/b1"] == "/(de|fr)/b{n}"
    assert got["http://a.org/en/b1"] == "/en/b{n}"


def test_branch_with_few_labels_is_merged_with_its_like(spark):
    """Four labels and 1,000 undecided URLs beside 100 blocked ones, and as many below other segments."""
    rules = (("block", "a.org", "/de/"), ("block", "a.org", "/fr/x7"), ("allow", "a.org", "/en/"), ("block", "a.org", "/it/y7"))
    urls = [f"http://a.org/{lang}/x{k}/{k}" for lang, n in (("de", 100), ("en", 60)) for k in range(n)]
    urls += [f"http://a.org/fr/x7/{k}" for k in range(4)] + [f"http://a.org/fr/x{k}/{k}" for k in range(1000, 2000)]
    urls += [f"http://a.org/it/y7/{k}" for k in range(4)] + [f"http://a.org/it/y{k}/{k}" for k in range(1000, 2000)]
    got = {urls[r.page_id]: r for r in U.judged(frame(spark, urls), rules).collect()}
    assert {r.verdict for u, r in got.items() if "/fr/" in u} == {"block"}
    assert {r.verdict for u, r in got.items() if "/it/" in u and r.rule is None} == {"allow"}
    assert {r.template.split("/")[1] for r in got.values()} == {"(de|fr)", "en", "it"}


def test_templates_go_as_deep_as_the_paths(spark):
    deep = "/a" * 12
    rules = (("block", "a.org", f"{deep}/bad/k"), ("allow", "a.org", f"{deep}/ok/k"))
    words = [f"{'k' if k < 20 else 'u'}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)]
    urls = [f"http://a.org{deep}/{kind}/{word}/{end}" for kind, end in (("bad", "b"), ("ok", "o")) for word in words]
    got = {urls[r.page_id]: r for r in U.judged(frame(spark, urls), rules).collect()}
    assert {r.template for u, r in got.items() if "/bad/" in u} == {f"{deep}/bad/*/b"}
    assert all(r.verdict == ("block" if "/bad/" in u else "allow") for u, r in got.items())


def test_alike_by_hand():
    def branch(name, n, bad, seen, **nexts):
        return U.Branch([name], n, bad, seen, nexts)
    def named(*own, prior=0.5):
        return [b.names for b in U.alike([*own], prior)]
    assert named(branch("a", 100, 100, 100, x=100), branch("b", 1004, 4, 4, x=1004), branch("c", 50, 0, 50, x=50)) == [["a", "b"], ["c"]]
    assert named(branch("a", 100, 100, 100, x=100), branch("b", 1004, 4, 4, y=1004)) == [["a"], ["b"]]
    assert named(branch("a", 100, 100, 100, x=100), branch("b", 100, 0, 0, x=100), prior=0.1) == [["a"], ["b"]]  # blocking is rare
    assert named(branch("a", 100, 0, 0, x=50, y=50), branch("b", 100, 0, 0, x=53, y=47), branch("c", 100, 0, 0, x=90, y=10)) == [["a", "b"], ["c"]]


def test_deep_and_repeated_paths(spark):
    urls = ["http://a.org" + "/x" * 40] * 3 + ["http://a.org" + "/x" * n for n in range(12)] + ["http://b.org/" + "y" * 100_000]
    got = U.judged(frame(spark, urls)).collect()
    assert len(got) == len(urls) and {r.verdict for r in got} == {"allow"}


def test_empty_table(spark):
    assert U.judged(frame(spark, []).where("false")).count() == 0
