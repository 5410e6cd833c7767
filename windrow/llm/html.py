"""Main text of web pages: roles of elements, and removal of each site's own template."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from windrow.llm.shared import checkpointed, mapped

#: A subtree is its site's template if it is on so many different pages of the host ...
LEAST_PAGES = 10
#: ... and on such a share of all of them, or of those in one folder, or of those with the path that it stands at.
LEAST_SHARE = 0.5
#: Subtrees of templates that may be broadcast, at 8 bytes each; of more, each page's own are joined to it.
BROADCAST_SUBTREES = 500_000
#: What a class says is aside is not if so many times less text is left of the page without it.
LEAST_LEFT = 10
#: Articles are the main text if they have such a part of the page's, else what holds them is.
LEAST_ARTICLE = 4

# Fixed values of HTML: elements without content, with raw text, and those that begin a block.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag closes if it is still open, and where the search for it ends.
IMPLIED = {t: frozenset({t}) for t in ("li", "tr", "option", "caption")}
IMPLIED |= dict.fromkeys(("dd", "dt"), frozenset({"dd", "dt"})) | dict.fromkeys(("td", "th"), frozenset({"td", "th"}))
IMPLIED |= dict.fromkeys(("tbody", "thead", "tfoot"), frozenset({"tbody", "thead", "tfoot"}))
SCOPES = frozenset("ul ol menu dl table html body article section div main".split())

#: Elements that never hold main text, and words in class, id or role that say so of others.
ASIDE_TAGS = frozenset(
    "head nav header footer aside form script style noscript iframe object embed template svg math canvas audio video button select "
    "option input textarea label fieldset dialog menu title xmp noembed noframes datalist search".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay subscribe subscription newsletter signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "aside footer header masthead toolbar pagination pager comment comments commentlist disqus reply replies respond discussion share "
    "sharing social related recommended recommendations widget complementary contentinfo search hidden sidenav topbar topnav skiplink "
    "disclaimer copyright adsbygoogle banners crumbs newsletters paywall".split()
)
#: Elements of the article itself; of the words above only these few say that one is something else.
MAIN_TAGS = frozenset({"article", "main"})
NOT_MAIN_WORDS = frozenset("comment reply ad advert advertisement sponsored promo teaser".split())
#: Within an article these words say nothing by themselves, and the first ones only beside one of the second.
OPEN_WORDS = frozenset("alert related recommended recommendations search discussion widget social menu overlay header footer hidden banner".split())
LISTED = (frozenset("related recommended recommendations".split()), frozenset("posts post articles stories links news reading items products topics".split()))

_MARKUP = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+)>?)""", re.S)
#: One attribute after the other, each with its whole value: nothing is looked for within values, and a quote
#: is one only where a value begins.
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?""")
_FOLDERS = re.compile(r"[^/?#]*//[^/?#]*/([^?#]*/)")
_NAME_WORD = re.compile(r"[A-Za-z][a-z]*")


@dataclass
class Element:
    tag: str
    name: str = ""
    aside: bool = False
    #: Whether only its class, id or role says that it is aside.
    by_name: bool = False
    children: list[Element | str] = field(default_factory=list)
    #: Digest of the tags and names from the root to this element, and that of its parent.
    path: int = 0
    above: int = 0
    #: Whether this is, or stands in, a paragraph of an article.
    paragraph: bool = False
    digest: int = 0
    n_words: int = 0


def _opened(tag: str, attributes: str, inside_main: bool, inside_article: bool, parent: Element) -> Element:
    words, names, hidden = set(), [], False
    if attributes and not attributes.isspace():
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif name in ("class", "id", "role"):
                names.append(value)
                words.update(w.lower() for w in _NAME_WORD.findall(value))
    aside = hidden or tag in ASIDE_TAGS and not (tag == "header" and inside_main)
    if tag in MAIN_TAGS:
        said = not NOT_MAIN_WORDS.isdisjoint(words)
    elif inside_main:
        said = not (ASIDE_WORDS - OPEN_WORDS).isdisjoint(words) or all(not of.isdisjoint(words) for of in LISTED)
    else:
        said = not ASIDE_WORDS.isdisjoint(words)
    name = " ".join(names)
    path = xxhash.xxh3_64_intdigest(f"{tag} {name}".encode("utf-8", "surrogatepass"), parent.path)
    paragraph = parent.paragraph or tag == "p" and inside_article
    return Element(tag, name, aside or said, said and not aside, path=path, above=parent.path, paragraph=paragraph)


class _Open:
    """The open elements, with the places of each tag and kind: nothing is searched for, however deep."""

    def __init__(self, root: Element):
        self.stack, self.places, self.kinds = [root], {}, {"block": [], "scope": [], "main": []}
        #: Elements up to here are known not to be aside, since they hold an article.
        self.cleared = 0

    def _of(self, tag: str) -> list[list[int]]:
        kinds = (("block", BLOCK), ("scope", SCOPES), ("main", MAIN_TAGS))
        return [self.places.setdefault(tag, []), *(self.kinds[k] for k, tags in kinds if tag in tags)]

    def last(self, *tags: str) -> int:
        """The place of the innermost open element of these tags; 0, the root's, if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def last_kind(self, kind: str) -> int:
        return self.kinds[kind][-1] if self.kinds[kind] else 0

    def push(self, element: Element) -> None:
        for places in self._of(element.tag):
            places.append(len(self.stack))
        self.stack.append(element)

    def close(self, place: int) -> None:
        """Closes all elements from a place on."""
        while len(self.stack) > place:
            for places in self._of(self.stack.pop().tag):
                places.pop()
        self.cleared = min(self.cleared, place)

    def clear(self) -> None:
        """What holds an article is not aside, whatever it is called."""
        for e in self.stack[self.cleared :]:
            e.aside = e.aside and e.tag in MAIN_TAGS
        self.cleared = len(self.stack)


def parse(html: str, host: str = "") -> Element:
    """The element tree; unclosed, crossed and cut-off markup is closed where it must end.

    Paths begin at the host: subtrees of different hosts have different ones.  Time grows in step with the
    page, however deep its elements are.
    """
    root = Element("html", path=xxhash.xxh3_64_intdigest(host.encode("utf-8", "surrogatepass")))
    held, at, end = _Open(root), 0, len(html)
    stack = held.stack
    while at < end:
        found = _MARKUP.search(html, at)
        if not found:
            stack[-1].children.append(unescape(html[at:]))
            break
        if found.start() > at:
            stack[-1].children.append(unescape(html[at : found.start()]))
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            place = held.last(tag)
            # an inline end tag does not reach over the block that it stands in
            if place and (tag in BLOCK or held.last_kind("block") <= place):
                held.close(place)
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCK and held.last("p") > held.last_kind("scope"):
            held.close(held.last("p"))  # a new block ends an open paragraph, and the inline elements within it
        if tag in IMPLIED and (place := held.last(*IMPLIED[tag])) > held.last_kind("scope"):
            held.close(place)
        element = _opened(tag, found[3], bool(held.kinds["main"]), bool(held.places.get("article")), stack[-1])
        stack[-1].children.append(element)
        if tag in MAIN_TAGS and not element.aside:
            held.clear()
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
        elif tag not in VOID and not found[3].endswith("/"):
            held.push(element)
    _settle(root)
    return root


def _settle(root: Element) -> None:
    """Takes back what names say of an element without which hardly any text of the page is left.

    An element that only its name calls aside is not, if it has ``LEAST_LEFT`` times the words of all that is
    left, the longest one first; within an article only if nothing else is left at all.
    """
    while True:
        left, doubtful = 0, []
        todo = [(root, False, None)]
        words: dict[int, int] = {}
        while todo:
            one, inside, by = todo.pop()
            inside = inside or one.tag in MAIN_TAGS
            for child in one.children:
                if isinstance(child, str):
                    n = len(child.split())
                    if by is None:
                        left += n
                    else:
                        words[id(by)] = words.get(id(by), 0) + n
                elif by is not None:
                    if not child.aside:
                        todo.append((child, inside, by))
                elif not child.aside:
                    todo.append((child, inside, None))
                elif child.by_name and child.tag not in MAIN_TAGS:
                    doubtful.append((child, inside))
                    todo.append((child, inside, child))
        found = [(words.get(id(e), 0), e) for e, inside in doubtful if words.get(id(e), 0) and (not left or not inside and words[id(e)] >= LEAST_LEFT * left)]
        if not found:
            return
        max(found, key=lambda x: x[0])[1].aside = False


def _digested(element: Element) -> None:
    """Digest of tag, names and content of each subtree, from the leaves up, without recursion."""
    todo = [(element, False)]
    while todo:
        one, ready = todo.pop()
        if not ready:
            todo.append((one, True))
            todo.extend((c, False) for c in one.children if isinstance(c, Element))
            continue
        state = xxhash.xxh3_64(f"{one.tag} {one.name}\0".encode("utf-8", "surrogatepass"))
        for child in one.children:
            if isinstance(child, Element):
                state.update(child.digest.to_bytes(8, "little"))
                one.n_words += child.n_words
            elif words := child.split():
                state.update(" ".join(words).encode("utf-8", "surrogatepass") + b"\0")
                one.n_words += len(words)
        one.digest = state.intdigest()


def _walk(element: Element, inside: bool = False) -> Iterator[tuple[Element, bool]]:
    """Subtrees outside of what is left out anyway, and whether an article holds them."""
    todo = [(element, inside)]
    while todo:
        one, inside = todo.pop()
        yield one, inside
        todo.extend((c, inside or one.tag in MAIN_TAGS) for c in reversed(one.children) if isinstance(c, Element) and not c.aside)


def _signed(digest: int) -> int:
    return (digest & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def _identity(e: Element) -> int:
    """What a subtree is counted by, as a signed long: its content and the path to it."""
    return _signed(e.digest * 0x9E3779B97F4A7C15 + e.above)


def _may_go(e: Element) -> bool:
    return e.tag not in MAIN_TAGS


def sections(url: str, host: str = "") -> list[int]:
    """The host, and each folder of the URL's path with those that hold it, as signed longs."""
    state = xxhash.xxh3_64(b"\0" + host.encode("utf-8", "surrogatepass"))
    found = [_signed(state.intdigest())]
    folders = _FOLDERS.match(url)
    for name in folders[1].split("/") if folders else ():
        if name:
            state.update(b"/" + name.encode("utf-8", "surrogatepass"))
            found.append(_signed(state.intdigest()))
    return found


def subtrees(html: str, host: str = "") -> tuple[int, list[int], dict[int, int | None]]:
    """A page's own digest, its elements' paths, and the identities of the subtrees that may be
    template, with the path that holds each, all as signed longs.

    In a paragraph of an article a path tells nothing (None): what several stories quote may have one of its own.
    """
    root = parse(html, host)
    _digested(root)
    elements = [e for e, _ in _walk(root)]
    found = {_identity(e): None if e.paragraph else _signed(e.above) for e in elements if e is not root and e.n_words and _may_go(e)}
    return _signed(root.digest ^ root.path), sorted({_signed(e.path) for e in elements}), found


def main_text(html: str, template: frozenset[int] = frozenset(), host: str = "") -> str:
    """Blocks of the article, joined by line ends; of the whole body where no element says what is main, or where what
    does is a small part of it."""
    root = parse(html, host)
    if template:
        _digested(root)

    def gone(e: Element) -> bool:
        return e.aside or bool(template) and _may_go(e) and _identity(e) in template

    def size(of: list[Element]) -> int:
        n, todo = 0, list(of)
        while todo:
            for child in todo.pop().children:
                if isinstance(child, str):
                    n += len(child.split())
                elif not gone(child):
                    todo.append(child)
        return n

    tops: list[Element] = []
    for tag in ("article", "main"):
        tops = tops or [e for e, inside in _walk(root) if e.tag == tag and not (inside and tag == "article")]
        if tops and LEAST_ARTICLE * size(tops) < size([root]):
            tops = []
    blocks, block = [], []

    def ended() -> None:
        if text := " ".join("".join(block).split()):
            blocks.append(text)
        block.clear()

    for top in tops or [root]:
        todo: list[Element | str | None] = [top]
        while todo:
            one = todo.pop()
            if one is None:
                ended()
            elif isinstance(one, str):
                block.append(one)
            elif one is top or not gone(one):
                if one.tag in ("br", "wbr"):
                    block.append(" ")
                    continue
                if one.tag in BLOCK:
                    ended()
                    todo.append(None)
                todo.extend(reversed(one.children))
        ended()
    return "\n".join(blocks)


def _host(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _cut(pages: DataFrame, url: str, html: str) -> DataFrame:
    """page, tag, url, sections, paths, subtrees, above of each row: see :func:`subtrees`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            urls, hosts = (batch.column(c).to_pylist() for c in ("url", "host"))
            found = [subtrees(h or "", host) for h, host in zip(batch.column("html").to_pylist(), hosts, strict=True)]
            columns = {"page": pa.array([p for p, _, _ in found], pa.int64()), "tag": batch.column("tag"), "url": batch.column("url")}
            columns["sections"] = pa.array([sections(u, h) for u, h in zip(urls, hosts, strict=True)], longs)
            columns["paths"] = pa.array([p for _, p, _ in found], longs)
            columns["subtrees"] = pa.array([[*s] for _, _, s in found], longs)
            yield pa.record_batch(columns | {"above": pa.array([[*s.values()] for _, _, s in found], longs)})

    narrow = pages.select(_host(url).alias("host"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), F.col(html).cast("string").alias("html"))
    lists = ("sections", "paths", "subtrees", "above")
    return mapped(narrow.withColumn("tag", _tag("host", "html")), work, "page long, tag long, url string, " + ", ".join(f"{c} array<long>" for c in lists))


def _tag(host: str, html: str):
    return F.xxhash64(host, F.coalesce(F.col(html), F.lit("")))


def site_templates(pages: DataFrame, url: str = "url", html: str = "html", least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """subtree: the identities of all sites' recurring subtrees, each of one host.

    A subtree is counted among all pages of its host, among those of each folder that its page is in,
    and, but for paragraphs of articles, among those that have the path at which it stands: so what a section or a
    kind of page has in common is found however many other pages the host has.  Copies of one page count once.
    """
    lists = ("sections", "paths", "subtrees", "above")
    distinct = _cut(pages, url, html).groupBy("page").agg(F.min_by(F.struct(*lists), "url").alias("cut")).select("cut.*")
    nothing = F.lit(None).cast("long")  # each page has one in each of its groups

    def pair(group, subtree):
        return F.struct(group.alias("group"), subtree.alias("subtree"))

    by_section = F.flatten(F.transform("sections", lambda g: F.transform(F.array_append("subtrees", nothing), lambda s: pair(g, s))))
    by_path = F.filter(F.zip_with("above", "subtrees", pair), lambda p: p["group"].isNotNull())
    of_paths = F.transform("paths", lambda g: pair(g, nothing))
    found = distinct.select(F.inline(F.concat(by_section, by_path, of_paths)))
    counts = checkpointed(found.groupBy("group", "subtree").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages))
    groups = counts.filter("subtree is null").select("group", F.col("n").alias("pages"))
    often = counts.filter("subtree is not null").join(groups, "group").filter(F.col("n") >= least_share * F.col("pages"))
    return often.select("subtree").distinct()


def extracted(pages: DataFrame, url: str = "url", html: str = "html", templates: DataFrame | None = None) -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars``.

    Null pages have an empty text.  Pages without a host are their own site, named "".  An empty
    table gives no rows.
    """
    templates = checkpointed(site_templates(pages, url, html) if templates is None else templates)
    others = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    columns = {f"c{i}": c for i, c in enumerate(others)}
    narrow = pages.select(*(F.col(c).alias(n) for n, c in columns.items()), F.col(html).cast("string").alias("html"), _host(url).alias("host"))
    few = templates.limit(BROADCAST_SUBTREES + 1).count() <= BROADCAST_SUBTREES
    if few:
        known = frozenset(templates.toArrow().column("subtree").to_pylist())
        shared = pages.sparkSession.sparkContext.broadcast(known)
    else:
        own = _cut(pages, url, html).select("tag", F.explode("subtrees").alias("subtree")).join(templates, "subtree")
        own = own.groupBy("tag").agg(F.collect_set("subtree").alias("template"))
        narrow = narrow.withColumn("tag", _tag("host", "html")).join(own, "tag", "left").drop("tag")
    schema = narrow.select(*columns, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shared.value] * batch.num_rows if few else [frozenset(t or ()) for t in batch.column("template").to_pylist()]
            rows = zip(batch.column("html").to_pylist(), own, batch.column("host").to_pylist(), strict=True)
            texts = [main_text(h or "", t, host) for h, t, host in rows]
            made = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(np.array([len(t) for t in texts], np.int64))}
            yield pa.record_batch({c: batch.column(c) for c in columns} | made)

    return mapped(narrow, work, schema).withColumnsRenamed(columns)
