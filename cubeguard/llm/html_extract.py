"""Main text of web pages by equivalence classes of template tokens.

Tokens are a page's block tags, each told apart by its path from the root with
classes, and its text blocks under their path. Pages of a host with the same text
outside menus and the like are copies and count as one. A token's occurrence vector
(how often it occurs on each page of its host) is carried as an exclusive-or of hashes
of (page, count), so it is gathered map-side and no task sees a whole host. Tokens of
one host that share a vector are an equivalence class; a class is valid if it has at
least two tokens, occurs on enough pages, and its tags hang below one other class. The
valid classes, nested, are the host's template: its text tokens are boilerplate on
every page, inside an article as well, and its slot with most running text outside
menus and the like is the article where the page names none itself.

A page's text is what remains in the slots of its article. A class name counts by the
word it ends in (``site-footer``, not ``share-price``); one above an article or main only
tells it from others that have none above them. A form round an article counts alike.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.llm.common import ship_code, store

#: A template class occurs on at least so many pages of its host, and this share.
MIN_PAGES, MIN_SHARE = 3, 0.5
#: Text of a template class is boilerplate from this share of the host's pages on.
TEXT_SHARE = 0.8

# Elements by their role.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
 ol p pre section summary table tbody td tfoot th thead title tr ul br""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "canvas", "select", "button", "title")
OUT = frozenset("head nav footer aside dialog menu".split())
MAIN = frozenset("article main".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
OUT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment
 comments cookie cookies consent disqus footer foot header masthead menu menubar modal nav navbar navigation newsletter
 notice notices notification overlay popup promo promotion related reply replies respond share sharing sidebar
 sidebars social sponsor sponsored subscribe teaser toolbar widget widgets""".split())
#: Words of a class name that say where or how, not what; states at its beginning or end say what the page has.
PARTS = frozenset("""area bar block body box button buttons col column container content group holder icons inner item left
 link links list outer panel right row section signup slot top unit wrap wrapper""".split())
STATES = frozenset("closed disabled enabled has is no not off on open shown visible with without".split())
READERS = frozenset("comment comments disqus reply replies respond".split())
#: Words that say so at the beginning of a name as well.
LEADS = READERS | frozenset("ad ads advert cookie cookies nav navbar newsletter related sponsored".split())
PARAGRAPHS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 td dd li".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"(?=[\s/>]|\w+=)|'[^']*'(?=[\s/>]|\w+=)|[^'\">])*+(?:['\"][^>]*)?)>|<[!?/][^>]*(?:>|\Z)|<[A-Za-z][^<>]*\Z", re.S | re.I)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    """A run of text between block tags."""

    __slots__ = ("path", "out", "above", "main", "text", "linked", "tag")

    def __init__(self, path: str, tag: str, out: bool, above: bool, main: int, text: str, linked: int):
        self.path, self.tag, self.out, self.above, self.main, self.text, self.linked = path, tag, out, above, main, text, linked


def named_out(name: str) -> str | None:
    """The word by which a class name or id is one of a menu, notice and the like: ``site-footer``,
    ``adBox``; none for ``has-sidebar``, ``comments-open`` or ``share-price``."""
    words = _WORD.findall(_CAMEL.sub(" ", name).lower())
    if not words or words[0] in STATES or words[-1] in STATES:
        return None
    if words[0] in LEADS:
        return words[0]
    while len(words) > 1 and words[-1] in PARTS:
        words.pop()
    return words[-1] if words[-1] in OUT_WORDS else None


def parsed(page: str) -> tuple[list[str], list[Block]]:
    """Paths of the block tags, and the text blocks, in page order."""
    paths: list[str] = []
    blocks: list[Block] = []
    # tag, path, out for certain, out by a class name or a form, such one above the article, 1 in main or 2 in an article
    stack: list[tuple[str, str, bool, bool, bool, int]] = [("", "", False, False, False, 0)]
    pieces: list[str] = []
    linked = depth = at = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                tag, path, sure, maybe, above, main = stack[-1]
                blocks.append(Block(path, tag, sure or maybe, above, main, text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            pieces.append(page[at:m.start()])
            linked += (m.start() - at) * (depth > 0)
        at = m.end()
        tag = (m["tag"] or "").lower()
        if m["raw"]:
            if m["raw"].lower() not in ("svg", "math", "object", "canvas"):
                pieces.append(" ")
            continue
        if tag == "a":
            depth = max(0, depth + (-1 if m["end"] else 1))
        if tag not in BLOCKS:
            continue
        flush()
        if tag in VOID:
            continue
        depth = 0
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        # Elements whose end tag may be left out end where the next such one begins.
        closes = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
        while len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] in closes):
            del stack[-1]
        found = {a[0].lower(): (a[1] or a[2] or a[3]) for a in _ATTR.findall(m["attrs"])} if m["attrs"] else {}
        names = f"{found.get('class', '')} {found.get('id', '')}".split()
        words = {w for name in names for w in _WORD.findall(_CAMEL.sub(" ", name).lower())}
        role = found.get("role", "").lower()
        _, path, sure, maybe, above, main = stack[-1]
        said = {named_out(n) for n in names} - {None} if tag not in ("html", "body", "main") else set()
        sure = sure or tag in OUT or "hidden" in found or role in OUT_ROLES or (bool(said & READERS) and tag != "article")
        maybe = maybe or bool(said) or tag in ("form", "fieldset") or (tag == "header" and main < 2)
        if tag in MAIN or role in ("main", "article"):
            main = max(main, 2 if "article" in (tag, role) else 1)
            above, maybe = above or maybe, False
        path = f"{path}/{tag}" + (f".{'.'.join(sorted(words))}" if words else "")
        stack.append((tag, path, sure, maybe, above, main))
        paths.append(path)
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return paths, blocks


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _container(path: str) -> str:
    """The path above the paragraph-like elements at its end."""
    parts = path.split("/")
    while len(parts) > 2 and parts[-1].partition(".")[0] in PARAGRAPHS | {"ul", "ol", "dl", "table", "tbody", "tr"}:
        parts.pop()
    return "/".join(parts)


_TOKENS = "host string, content long, digest long, tokens array<struct<token: long, above: long, is_text: boolean, n: long, mass: long>>"


def _tokens(batches):
    """(host, content, digest, tokens) of each page; copies within a batch come once."""
    for batch in batches:
        seen, rows, ends, cols = set(), [], [0], ([], [], [], [], [])
        for host, page in zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True):
            digest = _hash(page or "")
            if (host, digest) in seen:
                continue
            seen.add((host, digest))
            paths, blocks = parsed(page or "")
            counts: dict = {}
            for p in ["", *paths]:
                t = counts.setdefault(_hash(p), [_hash(p.rpartition("/")[0]), False, 0, 0])
                t[2] += 1
            for b in blocks:
                t = counts.setdefault(_hash(f"{b.path}\0{b.text}"), [_hash(b.path), True, 0, 0])
                t[2] += 1
                if not b.out:
                    home = counts.setdefault(_hash(_container(b.path)), [0, False, 0, 0])
                    home[3] += len(b.text) - 2 * b.linked
            content = _hash("\0".join(b.text for b in blocks if not b.out))
            rows.append((host, _signed(content), _signed(digest)))
            for token, (above, is_text, n, mass) in counts.items():
                for col, x in zip(cols, (_signed(token), _signed(above), is_text, n, mass), strict=True):
                    col.append(x)
            ends.append(len(cols[0]))
        names, types = ["token", "above", "is_text", "n", "mass"], [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
        held = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)], names=["host", "content", "digest", "tokens"])


def _rows(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))


def template_classes(pages: DataFrame) -> DataFrame:
    """The valid classes' tokens: host, token, above, is_text, pages, vector, above_vector, mass, host_pages."""
    # Copies of a content count once, or all of their text were on all pages.
    once = (_rows(pages).select("host", "html").mapInArrow(_tokens, _TOKENS)
            .groupBy("host", "content").agg(F.min_by("tokens", "digest").alias("tokens")))
    tokens = (once.select("host", "content", F.inline("tokens"))
              .groupBy("host", "token").agg(F.max("above").alias("above"), F.max("is_text").alias("is_text"), F.count(F.lit(1)).alias("pages"), F.bit_xor(F.xxhash64("content", "n")).alias("vector"), F.sum("mass").alias("mass")))
    tokens = tokens.where(F.col("pages") >= MIN_PAGES)  # a rarer token is in no template
    tokens = store(tokens)
    count = tokens.where(F.col("token") == _signed(_hash(""))).select("host", F.col("pages").alias("host_pages"))
    often = tokens.join(count, "host").where(F.col("pages") >= MIN_SHARE * F.col("host_pages"))
    up = often.select("host", F.col("token").alias("above"), F.col("vector").alias("above_vector"))
    nested = often.join(up, ["host", "above"], "left")
    # A text has nothing below it: what its class hangs below is up to the tags.
    outer = F.when(~F.col("is_text") & (F.col("above_vector") != F.col("vector")), F.col("above_vector"))
    valid = nested.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("size"), F.min(outer).alias("low"), F.max(outer).alias("high")).where("size >= 2 and (low is null or low = high)").select("host", "vector")
    return nested.join(valid, ["host", "vector"], "left_semi")


def templates(pages: DataFrame) -> DataFrame:
    """A row a host: its boilerplate text tokens and its slot with most running text.

    Both are bounded by a page: each token is on at least half of the host's pages.
    """
    held = template_classes(pages)
    text = F.when(F.col("is_text") & (F.col("pages") >= TEXT_SHARE * F.col("host_pages")), F.col("token"))
    heavy = F.max(F.when(~F.col("is_text") & (F.col("mass") > 0), F.struct("mass", "token")))
    return held.groupBy("host").agg(F.collect_list(text).alias("boilerplate"), heavy["token"].alias("slot"))


def article(page: str | None, boilerplate: frozenset, slot: int | None) -> str:
    """The text of a page's article, given its host's template.

    What is not boilerplate is in the template's slots; tags only choose among them.
    """
    _, blocks = parsed(page or "")
    blocks = [b for b in blocks if not b.out]
    own = [b for b in blocks if _signed(_hash(f"{b.path}\0{b.text}")) not in boilerplate]
    if any(b.main for b in blocks):
        own = [b for b in own if b.main]
        # Class names above an article only tell articles of a kind apart.
        clear = [b for b in own if not b.above]
        own = clear if max((b.main for b in clear), default=0) == max((b.main for b in own), default=0) else own
    else:
        in_slot = [b for b in own if slot is not None and _below(b.path, slot)]
        own = in_slot or [b for b in own if b.linked * 2 <= len(b.text)]
    return " ".join(b.text for b in own)


def _below(path: str, slot: int) -> bool:
    while path:
        if _signed(_hash(path)) == slot:
            return True
        path = path.rpartition("/")[0]
    return False


def _extract(batches):
    for batch in batches:
        texts = []
        for page, boilerplate, slot in zip(*(batch.column(c).to_pylist() for c in ("html", "boilerplate", "slot")), strict=True):
            texts.append(article(page, frozenset(boilerplate or ()), slot))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points of text).

    Null html counts as empty; a page without article text has an empty text. A null url
    has the empty host, whose pages share a template like any other's; a null page_id is
    carried. Repeated rows get equal results; an empty table gives an empty one. Broken or
    cut html is read as far as it goes. Other columns are not read.
    """
    ship_code(pages.sparkSession)
    host = store(templates(pages))
    rows = _rows(pages).join(host, "host", "left").select("page_id", "url", "html", "boilerplate", "slot")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
