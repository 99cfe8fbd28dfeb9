"""Main text of web pages by site template removal.

Every element subtree outside the prose of a marked article is hashed; Spark
counts in how many different pages of a host each hash occurs; subtrees that
recur across many pages of their host are the site's template and are deleted
first, wherever they stand in the page. Of what is left, boilerplate by tag,
role or class goes, then what is outside the articles of a page that marks some.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rttlab.session import persist_table

from . import spans as S
from .urls import host_of

MIN_PAGES, MIN_SHARE = 10, 0.1  # a template's subtree: in so many pages of the host, and so large a share of them
BODY_WORDS = 50  # recurring text outside links of so many words that is half of its page is the page's own

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
             "section summary table tbody td tfoot th thead title tr ul".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
             "h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th tr tbody thead tfoot caption figcaption summary".split())
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub "
             "sup time tt u var wbr img".split())
# End tags that may be left out: a start tag of the set closes an open element of the name, up to the given limits.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
# Boilerplate by tag, ARIA role, and word of an id or class.
DROP_TAGS = set("head title script style noscript template iframe object svg canvas audio video nav footer aside form button select "
                "textarea dialog menu".split())
DROP_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
DROP_WORDS = set("ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion cookie cookies consent "
                 "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar aside menu nav "
                 "navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus reply replies respond related "
                 "share sharing social toolbar pagination pager widget widgets login banner".split())
NEVER_BY_WORD = set("html body article main h1 h2 h3 h4 h5 h6".split())
_WORD = re.compile(r"[a-z0-9]+")
P_LIMITS = set("button table td th caption object template".split())


class Element:
    """``place`` numbers a page's elements in the order of their start tags, the root is 0."""
    __slots__ = ("tag", "attrs", "children", "parent", "drop", "depth", "place")

    def __init__(self, tag, attrs, parent, place):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.drop, self.depth, self.place = False, parent.depth + 1 if parent else 0, place


# A comment, declaration or processing instruction; or a tag: slash, name, attributes.
_TOKEN = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+[^>]*)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW_TEXT = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
_NO_ATTRS: dict[str, str] = {}


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace() or text == "/":
        return _NO_ATTRS
    return {m[0].lower(): unescape(m[1] or m[2] or m[3]) for m in reversed(_ATTR.findall(text))}  # the first of a name counts


class Open:
    """The open elements: ``at`` is the innermost; those of a name are a stack, so that none is searched for."""

    def __init__(self, root: Element):
        self.at = root
        self.named: dict[str, list[Element]] = {}

    def enter(self, e: Element) -> None:
        self.named.setdefault(e.tag, []).append(e)
        self.at = e

    def _innermost(self, names) -> Element | None:
        return max((self.named[n][-1] for n in names if self.named.get(n)), key=lambda e: e.depth, default=None)

    def close(self, names, limits=()) -> None:
        """Close the innermost element of ``names`` and all inside it, if there is one below ``limits``."""
        e = self._innermost(names)
        if e is None or limits and (bar := self._innermost(limits)) is not None and bar.depth > e.depth:
            return
        while True:
            inner = self.at
            self.named[inner.tag].pop()
            self.at = inner.parent
            if inner is e:
                return


def parse(html: str) -> Element:
    """Element tree of a page; unclosed and misnested tags are closed as browsers mostly do, references are decoded."""
    root = Element("#root", _NO_ATTRS, None, 0)
    now = Open(root)
    done = n = 0
    token = _TOKEN.search
    while m := token(html, done):
        if m.start() > done:
            data = html[done:m.start()]
            now.at.children.append(unescape(data) if "&" in data else data)
        done = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag not in VOID:
                now.close((tag,))
            continue
        if tag in ENDS_P:
            now.close(("p",), P_LIMITS)
        if tag in IMPLIED:
            now.close(*IMPLIED[tag])
        n += 1
        e = Element(tag, _attributes(m[3]), now.at, n)
        now.at.children.append(e)
        if tag in RAW_TEXT:
            end = RAW_TEXT[tag].search(html, done)
            stop = end.start() if end else len(html)
            e.children.append(html[done:stop])
            done = html.find(">", stop) + 1 if end else stop
            done = done or len(html)
        elif tag not in VOID:
            now.enter(e)
    if done < len(html):
        now.at.children.append(unescape(html[done:]))
    return root


def boilerplate(e: Element, in_article: bool) -> bool:
    """Menus, headers, footers, sidebars, notices, adverts, forms, comments, and what is never text."""
    if e.tag in DROP_TAGS or e.attrs.get("role", "").lower() in DROP_ROLES or "hidden" in e.attrs:
        return True
    if e.tag == "header":
        return not in_article
    if e.tag in NEVER_BY_WORD:
        return False
    words = set(_WORD.findall(f"{e.attrs.get('id', '')} {e.attrs.get('class', '')}".lower()))
    return bool(words & DROP_WORDS) or "header" in words and not in_article


def content_roots(root: Element) -> list[Element]:
    """The topmost articles that aren't boilerplate; else the main element; else the whole page."""
    found: dict[str, list[Element]] = {"article": [], "main": []}
    stack = [root]
    while stack:
        e = stack.pop()
        kind = "main" if e.tag == "main" or e.attrs.get("role") == "main" else \
            "article" if e.tag == "article" or e.attrs.get("role") == "article" else None
        if kind:
            found[kind].append(e)
        if kind != "article":
            stack += [c for c in reversed(e.children) if isinstance(c, Element) and not boilerplate(c, False)]
    articles = [a for a in found["article"] if not set(_WORD.findall(a.attrs.get("class", "").lower())) & DROP_WORDS]
    return articles or found["main"] or [root]


def subtree_hashes(root: Element, roots: list[Element]) -> dict[int, list[Element]]:
    """Elements by the hash of their subtree: name, id, class, texts and children; those a template may hold.

    ``roots``: the page's content roots. Left out: prose, what holds prose, and inline elements inside a marked
    article, page-level shells (html, body, the roots of the content), and
    subtrees without text.
    """
    marked = {id(r) for r in roots if r is not root}
    shells = ("#root", "html", "body", "head")
    out: dict[int, list[Element]] = {}

    def may(e: Element, inside: bool) -> bool:
        return e.tag not in shells and id(e) not in marked and e.tag not in INLINE and not (inside and e.tag in PROSE)

    def digest(e: Element, inside: bool) -> bytes:
        h = xxhash.xxh64(f"{e.tag}\0{e.attrs.get('id', '')}\0{e.attrs.get('class', '')}")
        text = prose = False
        for c in e.children:
            if isinstance(c, str):
                words = " ".join(c.split())
                h.update(b"t" + words.encode("utf-8", "replace"))
                text = text or bool(words)
            else:
                d = below[id(c)]
                h.update(b"e" + d[:8])
                text = text or d[8:] != b"0"
                prose = prose or d[8:] == b"2"
        prose = prose or text and e.tag in PROSE
        if text and may(e, inside) and not (inside and prose):
            out.setdefault(h.intdigest() - (1 << 63), []).append(e)
        return h.digest() + (b"2" if prose else b"1" if text else b"0")

    todo = [(root, False)]
    while todo:  # down to the topmost elements that may be a template's, whose subtrees are hashed from the leaves up
        e, inside = todo.pop()
        inside = inside or id(e) in marked
        if not may(e, inside):
            todo += [(c, inside) for c in e.children if not isinstance(c, str)]
            continue
        order, at, below = [], [(e, inside)], {}
        while at:
            x = at.pop()
            order.append(x)
            at += [(c, x[1] or id(c) in marked) for c in x[0].children if not isinstance(c, str)]
        for x, within in reversed(order):
            below[id(x)] = digest(x, within)
    return out


def _letters(top: Element, dropped: bool, links: bool = True) -> tuple[int, int]:
    """Characters and words of text that isn't boilerplate below ``top``; with ``dropped``, of that in dropped elements
    only; without ``links``, of that outside links."""
    n = w = 0
    stack = [(top, not dropped or top.drop)]
    while stack:
        e, counts = stack.pop()
        for c in e.children:
            if isinstance(c, str):
                words = c.split() if counts else ()
                n, w = n + sum(map(len, words)), w + len(words)
            elif not boilerplate(c, True) and (links or c.tag != "a"):
                stack.append((c, counts or c.drop))
    return n, w


def _spare(root: Element, roots: list[Element], dropped: list[Element]) -> None:
    """Take back deletions that would take the page's own text.

    Of a marked article (or main element): all, where they hold half of its
    text or more. Of a page without one: those of mostly unlinked text, where
    the unlinked text of all has ``BODY_WORDS`` words and is half of the page's.
    """
    marked = [r for r in roots if r is not root]
    for r in marked:
        if 2 * _letters(r, True)[0] >= _letters(r, False)[0]:
            stack = [r]
            while stack:
                e = stack.pop()
                e.drop = False
                stack += [c for c in e.children if not isinstance(c, str)]
    if not marked:
        n, words = _letters(root, True, links=False)
        if words >= BODY_WORDS and 2 * n >= _letters(root, False)[0]:
            for e in dropped:
                if 2 * _letters(e, False, links=False)[0] >= _letters(e, False)[0]:
                    e.drop = False


def main_text(html: str, template=()) -> str:
    """Text of the page: without the elements whose places are in ``template``, then without boilerplate by tag, role
    and class, then of its articles (or main element) alone if it has any.

    Blocks are joined by one space, white space is one space. What
    :func:`_spare` finds to be the page's own text stays.
    """
    root = parse(html)
    roots = content_roots(root)
    if len(template):
        gone, dropped, stack = set(template), [], [root]
        while stack:
            e = stack.pop()
            if e.place in gone:
                e.drop = True
                dropped.append(e)
            stack += [c for c in e.children if not isinstance(c, str)]
        _spare(root, roots, dropped)
    parts: list[str] = []
    for top in roots:
        stack: list = [(top, top is not root)]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                parts.append(x)
                continue
            e, inside = x
            if e.drop or e is not top and boilerplate(e, inside):
                parts.append(" ")
                continue
            if e.tag in BLOCKS:
                parts.append(" ")
                stack.append(" ")
            stack += [c if isinstance(c, str) else (c, inside) for c in reversed(e.children)]
        parts.append(" ")
    return " ".join("".join(parts).split())


def _same(a: list[str], b: list[str]):
    both = F.lit(True)
    for x, y in zip(a, b, strict=True):
        both = both & (F.col(x) == F.col(y))
    return both


def template_places(pages: DataFrame, html: str = "html", url: str = "url", min_pages: int = MIN_PAGES,
                    min_share: float = MIN_SHARE) -> DataFrame:
    """``page1, page2, host, template``: per different page of a host that has any, the places of its elements whose
    subtree is the host's template. ``page1`` and ``page2`` are hashes of the html.

    ``min_pages`` and ``min_share`` are of the host's different pages: rows of equal html are one page.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, places = [], []
            for page in b.column(3).to_pylist():
                tree = parse(page or "")
                found = [(h, e.place) for h, es in subtree_hashes(tree, content_roots(tree)).items() for e in es]
                hashes.append([h for h, _ in found])
                places.append([p for _, p in found])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                                             names=[*key, "hashes", "places"])

    key = ["host", "page1", "page2"]
    found = S.map_batches(_page_key(pages, html, url).select(*key, F.col(html).alias("html")), run,
                          "host string, page1 long, page2 long, hashes array<long>, places array<int>")
    different = persist_table(found.groupBy(*key).agg(F.first(F.struct("hashes", "places")).alias("f")), "html-subtrees")
    host_pages = different.groupBy(F.col("host").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    often = (different.select("host", F.explode(F.array_distinct("f.hashes")).alias("hash"))
             .groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
             .join(host_pages, F.col("host") == F.col("h")).filter(F.col("pages") >= F.lit(min_share) * F.col("n")).select("host", "hash"))
    here = different.select(*key, F.explode(F.arrays_zip("f.hashes", "f.places")).alias("x"))
    here = here.select(*key, F.col("x.hashes").alias("hash"), F.col("x.places").alias("place"))
    return here.join(often, ["host", "hash"], "left_semi").groupBy(*key).agg(F.collect_set("place").alias("template"))


def _page_key(pages: DataFrame, html: str, url: str) -> DataFrame:
    """``pages`` with ``host``, and two hashes of the html (a null is empty)."""
    page = F.coalesce(F.col(html), F.lit(""))
    return (pages.withColumn("page1", F.xxhash64(page)).withColumn("page2", F.xxhash64(F.lit(1), page))
            .withColumn("host", host_of(F.col(url))))


def extract(pages: DataFrame, html: str = "html", url: str = "url", min_pages: int = MIN_PAGES,
            min_share: float = MIN_SHARE) -> DataFrame:
    """``pages`` without ``html``, with ``text`` (main text, empty if none) and ``n_chars`` (its code points).

    Null or empty html gives an empty text; a null url counts to the host
    with the empty name. Repeated rows each keep their row. Input columns named
    ``text`` or ``n_chars`` are replaced, all others come back as they are; an
    empty table stays empty. Whole pages are read, whatever their length.
    """
    rest = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    packed = pages.select(F.struct(*rest).alias("rest") if rest else F.lit(True).alias("rest"),
                          F.col(html).alias("html"), F.col(url).alias("url"))
    templates = (template_places(packed, min_pages=min_pages, min_share=min_share)
                 .withColumnsRenamed({"page1": "t1", "page2": "t2", "host": "th"}).hint("shuffle_hash"))
    both = _page_key(packed, "html", "url").join(templates, _same(["page1", "page2", "host"], ["t1", "t2", "th"]), "left")
    both = both.select("rest", "html", "template")
    schema = both.select("rest").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(page or "", places or ()) for page, places in
                     zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["rest", "text", "n_chars"])

    return S.map_batches(both, run, schema).select(*[F.col("rest")[c].alias(c) for c in rest], "text", "n_chars")


def op10_html_text(spark, sf: str) -> DataFrame:
    """Main text of every page of ``pages``."""
    return extract(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html"))
