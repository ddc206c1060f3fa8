import html
import re

import pytest

from cubeguard.llm import html_extract as H

SCHEMA = "page_id long, url string, html string, host string, token long"
PAGES = "/root/testdata/sf0.001/pages.parquet"


def text(page):
    return H.article(page, frozenset(), None)


@pytest.mark.parametrize("page, want", [
    ("<article><h1>A &amp; b</h1><p>c<b>d</b> e\n f</article><footer>x</footer>", "A & b cd e f"),
    ("<body><nav>m</nav><main><p>one<br>two<p>three</main>", "one two three"),
    ("<main><header>h</header>a<aside>s</aside><div class='comments'>c</div><div id=cookie-notice>n</div>b<form>f</form></main>", "a b"),
    ("<article>a<script>var t='</p>';</script><style>p{}</style><!-- x --> b&nbsp;&lt;i&gt; &#233;&#x41; &am &amp</article>", "a b <i> éA &am &"),
    ("<article><p>a < b and 3<4</p><p title=\"x > y\">c</p></article>", "a < b and 3<4 c"),
    ("<article><p>cut here <foot", "cut here"),
    ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>", "x y 1 2"),
    ("<article><div class='article-body lead'>ok</div><div class=adBox>no</div><div hidden>no</div><div role=navigation>no</div></article>", "ok"),
    ("<head><title>t</title></head><body><p>plain</p></body>", "plain"), ("", ""), (None, ""), ("no tags", "no tags")])
def test_article(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<div class='content has-sidebar'><article><p>a</p></article></div>", "a"), ("<article class='post comments-open'>a</article>", "a"),
    ("<main><div class='share-price'>12 a share</div><div class=menu-items>Soup</div></main>", "12 a share Soup"),
    ("<header>h</header><article><header><h1>Head</h1></header><p>a</p><footer>f</footer></article>", "Head a"),
    ("<div class='content sidebar'><article>a</article></div>", "a"), ("<form id=all><nav>n</nav><main>a<form>f</form></main></form>", "a"),
    ("<article>a</article><div id=comments><article class=comment>c</article></div><div class=teaser><article>t</article></div>", "a"),
    ("<article>a<ol class='comment-list'><li><article>c</article></ol><div class='related-posts'>r</div></article><aside><article>s</article></aside>", "a"),
    ("<main><p>a</p><div class='wide sidebar'><article>b</article></div></main>", "a b"),
    ("<article><p title='a>b>c</p><p>it's d</p></article>", "b>c it's d"), ("<article><p title=\"x>y\"class=z>c</p></article>", "c")])
def test_class_names_and_broken_quotes(page, want):
    assert text(page) == want


def test_driver_pages(spark):
    df = spark.read.parquet(PAGES)
    own = {r.page_id: r.html for r in df.collect()}
    for r in H.extract(df).collect():
        body = re.search(r"<article>(.*)</article>", own[r.page_id], re.S).group(1)
        assert r.text == " ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*>", " ", body)).split()) and r.n_chars == len(r.text)


def site(k, host="h.example"):
    return (k, f"http://{host}/{k}", f"""<html><body><div class=top><div>Welcome to our site</div><div>All rights kept</div></div>
      <div class=box><div class=story><p>Story {k} begins with words of its own {k * 7}.</p><p>It goes on {k * 13} and ends.</p></div>
      <div class=more><p>Read more {k}</p></div></div><div>Made with care</div></body></html>""", "clash", 1)


def test_slots_of_a_template_without_article_tags(spark):
    rows = [site(k) for k in range(12)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: f"Story {k} begins with words of its own {k * 7}. It goes on {k * 13} and ends." for k in range(12)}


def test_classes_by_brute_force(spark):
    """Tokens share a class where their counts agree on every page."""
    rows = [site(k) for k in range(8)] + [(9, "http://h.example/9", "<html><body><div class=top><div>Welcome to our site</div></div></body></html>", "", 1)]
    got = {}
    for r in H.template_classes(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.vector, set()).add(r.token)
    vectors = {}
    for page_id, _, page, *_ in rows:
        paths, blocks = H.parsed(page)
        for t in [*["", *paths], *[f"{b.path}\0{b.text}" for b in blocks]]:
            vectors.setdefault(t, {}).setdefault(page_id, 0)
            vectors[t][page_id] += 1
    classes = {}
    for t, v in vectors.items():
        if len(v) >= 5:
            classes.setdefault(tuple(sorted(v.items())), set()).add(H._signed(H._hash(t)))
    for members in got.values():
        assert any(members <= c for c in classes.values())
    assert max(len(m) for m in got.values()) >= 4


def named(k, story, host="n.example", ad=""):
    """A page with a menu, an article, and a notice that no class name gives away."""
    return (k, f"http://{host}/{k}", f"""<html><body><ul><li>Home</li><li>News</li></ul><article><h1>Title {story}</h1><div>Read our terms before use</div>
      <p>Story {story} in words of its own.</p><p>It ends {story * 13}.</p><p>Write to us</p></article><div class=ad>{ad}</div><div>Made with care</div></body></html>""", "clash", 1)


def test_template_is_dropped_inside_an_article(spark):
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame([named(k, k) for k in range(9)], SCHEMA)).collect()}
    assert got == {k: f"Title {k} Story {k} in words of its own. It ends {k * 13}." for k in range(9)}


def test_copies_are_no_template(spark):
    """Nine copies beside another ad are one page; two contents are too few for a template."""
    rows = [named(k, 5, "copies.example", f"ad {k}") for k in range(9)] + [named(9, 6, "copies.example")]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: f"Title {s} Read our terms before use Story {s} in words of its own. It ends {s * 13}. Write to us" for k, s in [*((k, 5) for k in range(9)), (9, 6)]}


def test_copies_do_not_outvote_other_pages(spark):
    rows = [named(k, 5 if k < 40 else k) for k in range(45)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: f"Title {s} Story {s} in words of its own. It ends {s * 13}." for k, s in ((k, 5 if k < 40 else k) for k in range(45))}


def test_awkward_pages(spark):
    rows = [(1, None, "<p>a</p>", "", 1), (None, "http://x/1", "<p>b</p>", "", 1), (None, "http://x/1", "<p>b</p>", "", 1), (2, "nothing", None, "", 1), (3, "http://x/2", "", "", 1), (4, "HTTP://X/3", "<p>" + "long " * 50_000, "", 1)]
    got = sorted(((r.page_id or 0, r.text[:4], r.n_chars) for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == [(0, "b", 1), (0, "b", 1), (1, "a", 1), (2, "", 0), (3, "", 0), (4, "long", 249_999)]
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0
