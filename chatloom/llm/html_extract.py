"""Main text of web pages: same-host template deduction by equivalence classes of tokens.

A page is a sequence of tokens: its tags with their attributes at their place, and its texts
at theirs. Tokens that occur equally often in the same pages of a host are an equivalence
class. Classes whose tokens keep one order, and lie whole in one gap of every class around
them, nest; together they are the host's templates. What stands between their tokens are
the slots, and the page's own text is what fills them.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Set
from dataclasses import dataclass
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.plans.staging import stage

# The element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe template noframes xmp".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mover mroot "
    "mrow ms msqrt msub msubsup msup mtext munder q rp rt ruby s samp semantics small span strike strong sub sup "
    "time tt u var wbr".split()
)
#: Elements that a new block element, or one like them, closes.
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())
_AROUND_P = ("article", "div", "section", "li", "td", "table", "blockquote", "body")
_AROUND_ITEMS = ("ul", "ol", "dl", "table", "select", "article", "div", "section")

#: Containers of what is no article text.
SKIP_ELEMENTS = frozenset("nav footer aside form button select menu dialog head".split()) | RAW
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu".split())
#: Class and id values of what is no article text. Inside a marked article a value must be one
#: of them as a whole; elsewhere one of its words is enough.
SKIP_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense adslot sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe signup login comment comments respond replies disqus share "
    "sharing social related recommended widget pagination pager toolbar".split()
)
_IN_ARTICLE = frozenset("ad ads advert adverts advertisement adsense adslot comments disqus newsletter".split())
MAIN_ELEMENTS = ("main", "article")
#: Elements that name what comes after them.
LABELS = ("h1", "h2", "h3", "h4", "h5", "h6", "dt", "th", "caption", "figcaption", "legend", "summary")

# A quoted value may hold a >. Tags without an end that is near are cut at the first >.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ROUGH = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_LONGEST_TAG = 2048
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++)|(?<!\S)(hidden)(?=[\s/>]|$)""")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    """One block of text and where it stands: ``at`` counts tokens, ``path`` is a hash of the place."""

    path: int
    text: str
    skipped: bool
    main: int  # 0 outside, else the place in MAIN_ELEMENTS, from 1
    linked: int
    named: bool = False  # only a name says that it is no article text
    at: int = 0
    label: bool = False  # names what comes after it


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def text_token(block: Block) -> int:
    """A block's text at its path: the token that is constant if it belongs to a template."""
    return _hash(f"{block.path}\x00{block.text}")


def _skips(name: str, attributes: str, in_main: bool) -> tuple[bool, bool]:
    """Whether an element holds no article text: by what it is, and by what it is called."""
    if name in SKIP_ELEMENTS or (name in ("header", "noscript") and not in_main):
        return True, False
    named = False
    for key, value, hidden in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        key, value = key.lower(), value.strip("\"'")
        if hidden or key == "hidden" or (key == "role" and value.lower() in SKIP_ROLES):
            return True, False
        if key in ("class", "id") and name not in ("html", "body", "main", "article"):
            if in_main:
                named = named or bool(_IN_ARTICLE & set(value.lower().split()))
            else:
                named = named or bool(SKIP_NAMES & set(_WORD.findall(_CASE.sub(" ", value).lower())))
    return False, named


class _Reader:
    """Walks a page once and cuts it into blocks and tokens; every step pays for itself."""

    def __init__(self, html: str, *, tokens: bool = True) -> None:
        self.html = html
        self.wanted = tokens
        #: open elements: name, path, skipped, named, main; each with what is above it
        self.open: list[tuple[str, int, bool, bool, int]] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[Block] = []
        self.tokens: list[int] = []

    def flush(self) -> None:
        if not self.parts:
            return
        text = _SPACE.sub(" ", unescape("".join(self.parts))).strip()
        if text:
            _, path, skipped, named, main = self.open[-1] if self.open else ("", 0, False, False, 0)
            label = any(self.places[name] for name in LABELS)
            block = Block(path, text, skipped, main, self.linked, named, len(self.tokens), label)
            self.blocks.append(block)
            if self.wanted:
                self.tokens.append(text_token(block))
        self.parts, self.linked = [], 0

    def close_to(self, name: str, stops: tuple[str, ...] = ()) -> None:
        """Close the innermost ``name``, unless one of ``stops`` is open inside it."""
        if not (places := self.places[name]):
            return
        if any(self.places[stop] and self.places[stop][-1] > places[-1] for stop in stops):
            return
        at = places[-1]
        while len(self.open) > at:
            self.places[self.open.pop()[0]].pop()

    def start(self, name: str, attributes: str) -> None:
        if name in VOID:
            if name not in INLINE:
                self.parts.append(" ")
            if name == "hr":
                self.flush()
            return
        if name not in INLINE:
            self.flush()
            self.close_to("p", _AROUND_P)
            if name in CLOSED_BY_SAME:
                self.close_to(name, _AROUND_ITEMS)
        _, path, skipped, named, main = self.open[-1] if self.open else ("", 0, False, False, 0)
        if name in MAIN_ELEMENTS and not skipped and not named:
            main = max(main, MAIN_ELEMENTS.index(name) + 1)
        by_kind, by_name = _skips(name, attributes, bool(main))
        if name not in INLINE and self.wanted:
            path = _hash(f"{path}/{name}")
            self.tokens.append(_hash(f"{path} {_SPACE.sub(' ', attributes).strip()}"))
        self.places[name].append(len(self.open))
        self.open.append((name, path, skipped or by_kind, named or by_name, main))

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.flush()
        self.close_to(name)

    def text(self, value: str) -> None:
        self.parts.append(value)
        if self.places["a"]:
            self.linked += len(value)

    def read(self) -> _Reader:
        html, at, n = self.html, 0, len(self.html)
        last = html.rfind(">")
        while at < n:
            begin = html.find("<", at)
            if begin < 0 or begin > last:
                self.text(html[at:])
                break
            if begin > at:
                self.text(html[at:begin])
            if html.startswith("<!--", begin):
                close = html.find("-->", begin + 4)
                at = n if close < 0 else close + 3
                continue
            if html[begin + 1 : begin + 2] in ("!", "?"):
                at = html.find(">", begin) + 1
                continue
            found = _TAG.match(html, begin, begin + _LONGEST_TAG)
            if not found and html[begin + 1 : begin + 2] not in ("", " "):
                # ``last`` lies behind, so this ends; it goes on from there.
                found = _ROUGH.match(html, begin)
            if not found:
                self.text("<")
                at = begin + 1
                continue
            at = found.end()
            name = found[2].lower()
            if found[1]:
                self.end(name)
            elif name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>|\Z", re.I).search(html, at)
                if name not in INLINE:
                    self.flush()
                at = max(close.end(), at)
            else:
                self.start(name, found[3])
        self.flush()
        return self


def page_blocks(html: str | None) -> list[Block]:
    """The text blocks of a whole page in order, without paths; markup errors never fail.

    Time grows with the length of the page, however deep or broken its markup is.
    """
    return _Reader(html, tokens=False).read().blocks if html else []


def story_of(blocks: list[Block]) -> int:
    """What tells pages apart: their longest text outside of menus and the like.

    Near copies of one page have it in common, so they count as one page.
    """
    own = [b.text for b in blocks if not b.skipped and not b.named and 2 * b.linked < len(b.text)]
    return _hash(max(own, key=len, default=""))


def host_of(url):
    """Host of a URL column, lower case; pages without one share the host ''."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def crossing(tokens: list[tuple[int, int]]) -> set[int]:
    """Classes that do not nest, from one page's (position, class) in order.

    A class is open from its first to its last token. When one goes on while a class begun
    inside it is still open, the inner one lies in two of its gaps.
    """
    left = Counter(c for _, c in tokens)
    stack: list[int] = []
    bad: set[int] = set()
    inside: set[int] = set()
    for _, c in tokens:
        while stack and not left[stack[-1]]:
            inside.discard(stack.pop())
        if c in bad:
            continue
        if c in inside:
            while stack[-1] != c:
                over = stack.pop()
                inside.discard(over)
                if left[over]:
                    bad.add(over)
        else:
            stack.append(c)
            inside.add(c)
        left[c] -= 1
    return bad


_TOKENS = "array<struct<token:long,n:int,first:int>>"


def _page_tokens(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, story, page, tokens): each token of a page with its number and first position."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int32()), ("first", pa.int32())]))
        for batch in batches:
            stories, keys, tokens = [], [], []
            for html in batch.column(1).to_pylist():
                page = _Reader(html or "").read()
                first: dict[int, int] = {}
                for i, token in enumerate(page.tokens):
                    first.setdefault(token, i)
                number = Counter(page.tokens)
                stories.append(story_of(page.blocks))
                keys.append(_hash(html or ""))
                tokens.append([{"token": t, "n": number[t], "first": i} for t, i in first.items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(stories, pa.int64()), pa.array(keys, pa.int64()), pa.array(tokens, kind)],
                ["host", "story", "page", "tokens"],
            )

    return pages.select(host_of(F.col(url_col)).alias("host"), html_col).mapInArrow(
        read, f"host string, story long, page long, tokens {_TOKENS}"
    )


def template_classes(
    pages: DataFrame,
    *,
    url_col: str = "url",
    html_col: str = "html",
    share: float = 0.75,
    least_pages: int = 4,
    least_tokens: int = 3,
) -> DataFrame:
    """(host, class, token, common): the tokens of each host's valid equivalence classes.

    A token's occurrence vector has its count in each page of the host. Tokens with equal
    vectors are a class; vectors are told by their support and a sum of hashes of (page,
    count), which adds up in partial aggregates, so a host with most pages is no single task.
    Classes are taken from ``least_tokens`` tokens and ``least_pages`` pages with one count in
    each, or from one token in ``share`` of the pages. A host may have several templates: their
    classes have different supports. A class is valid if its tokens have the same order in
    all its pages, and if it lies in one gap of each class around it in all of them; both
    are worked out page by page. Pages with one story count once. ``common`` tells tokens in
    ``share`` of the pages.
    """
    parsed = _page_tokens(pages, url_col, html_col)
    different = stage(
        parsed.groupBy("host", "story").agg(F.min_by("tokens", "page").alias("tokens")), "tokens"
    )
    sizes = different.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    each = different.select("host", "story", F.explode("tokens").alias("t")).select("host", "story", "t.*")
    vectors = each.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("support"),
        F.sum(F.xxhash64("story", "n").cast("decimal(38,0)")).alias("vector"),
        F.min("n").alias("low"),
        F.max("n").alias("high"),
    )
    even = vectors.where((F.col("low") == F.col("high")) & (F.col("support") >= least_pages))
    even = even.withColumn("class", F.xxhash64("host", "support", "vector"))
    large = even.groupBy("host", "class").agg(F.count(F.lit(1)).alias("size"), F.max("support").alias("support"))
    large = large.join(sizes, "host").where(
        (F.col("size") >= least_tokens) | (F.col("support") >= share * F.col("pages"))
    )
    large = large.select("host", "class", (F.col("support") >= share * F.col("pages")).alias("common"))
    classed = stage(even.join(large, ["host", "class"]).select("host", "class", "token", "common"), "classes")
    placed = each.join(classed.drop("common"), ["host", "token"]).select("host", "story", "class", "token", "first")
    by_page = stage(
        placed.groupBy("host", "story").agg(F.sort_array(F.collect_list(F.struct("first", "class", "token"))).alias("at")),
        "placed",
    )
    inner = by_page.select(
        "host", "story", F.posexplode("at").alias("i", "a")
    ).select("host", "story", "i", F.col("a.class").alias("class"), F.col("a.token").alias("token"))
    ordered = inner.groupBy("host", "story", "class").agg(
        F.xxhash64(F.transform(F.sort_array(F.collect_list(F.struct("i", "token"))), lambda x: x["token"])).alias("order")
    )
    unordered = ordered.groupBy("host", "class").agg(F.min("order").alias("a"), F.max("order").alias("b")).where("a <> b")

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, classes = [], []
            for host, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = crossing([(x["first"], x["class"]) for x in at])
                hosts += [host] * len(found)
                classes += found
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(classes, pa.int64())], ["host", "class"])

    crossed = by_page.select("host", "at").mapInArrow(cross, "host string, class long")
    bad = unordered.select("host", "class").unionByName(crossed).distinct()
    return classed.join(bad, ["host", "class"], "left_anti")


def templates(pages: DataFrame, **settings) -> DataFrame:
    """(host, common, other): all tokens of each host's templates."""
    return template_classes(pages, **settings).groupBy("host").agg(
        F.collect_list(F.when(F.col("common"), F.col("token"))).alias("common"),
        F.collect_list(F.when(~F.col("common"), F.col("token"))).alias("other"),
    )


@dataclass
class Slot:
    """What one gap between template tokens holds: its place (the token before it), and its blocks."""

    place: int
    blocks: list[Block]


def _slots(page: _Reader, template: set[int]) -> list[Slot]:
    by_place = {b.at: b for b in page.blocks}
    slots: list[Slot] = []
    before, fresh = 0, True
    for i, token in enumerate(page.tokens):
        if token in template:
            before, fresh = token, True
        elif i in by_place:
            if fresh:
                slots.append(Slot(before, []))
                fresh = False
            slots[-1].blocks.append(by_place[i])
    return slots


def page_slots(html: str | None, template: set[int]) -> list[Slot]:
    """The slots of a page with text in them, in order."""
    return _slots(_Reader(html).read(), template) if html else []


def _readable(blocks: list[Block]) -> list[Block]:
    return [b for b in blocks if not b.skipped and not b.named and 2 * b.linked < len(b.text)]


def _labelled(blocks: list[Block], filled: list[Block]) -> list[Block]:
    """The blocks of slots, and the template's labels that stand before one of them."""
    own = {b.at for b in filled}
    last = max(own, default=-1)
    return [b for b in blocks if b.at in own or (b.label and b.at < last)]


def main_text(html: str | None, template: set[int], common: Set[int] = frozenset()) -> str:
    """The article of a page; '' if none.

    The article is what the slots of the host's template hold, less menus, adverts and the
    like. A marked article (else a main element) tells which slots: there nothing else goes,
    only tokens in most of the host's pages (``common``) are template, and its headings and
    other labels stay where text of the page follows. Without such a mark, blocks that are
    mostly links, or called an advert or the like, go too. Where a template would take more
    than half of that text, as with pages that are nearly the same, and on hosts without a
    template, it is all text that is none of those.
    """
    if not html:
        return ""
    page = _Reader(html).read()
    most = max((b.main for b in page.blocks), default=0)
    if most:
        chosen = [b for b in page.blocks if b.main == most and not b.skipped and not b.named]
    else:
        chosen = _readable(page.blocks)
    if known := common if most else template:
        able = {b.at for b in chosen}
        filled = [b for slot in _slots(page, known) for b in slot.blocks if b.at in able]
        if most:
            filled = _labelled(chosen, filled)
        if 2 * sum(len(b.text) for b in filled) >= sum(len(b.text) for b in chosen):
            chosen = filled
    return "\n\n".join(b.text for b in chosen)


def extract_main(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    share: float = 0.75,
    least_pages: int = 4,
) -> DataFrame:
    """(id, url, text) for every row of ``pages``.

    Reads the whole html, whatever its length or depth; null or empty html has the text ''.
    Hosts with few different pages have no template, and pages without a host share one.
    Repeated rows are extracted alike and count once in the template. Templates are small,
    one row per host. Other columns are not read.
    """
    found = templates(pages, url_col=url_col, html_col=html_col, share=share, least_pages=least_pages)
    template = found.select(F.col("host").alias("_host"), "common", "other")
    joined = pages.select(
        F.col(id_col), F.col(url_col), F.col(html_col), host_of(F.col(url_col)).alias("_h")
    ).join(stage(template, "templates"), F.col("_h") == F.col("_host"), "left")

    @F.pandas_udf("string")
    def extract(hosts: pd.Series, htmls: pd.Series, commons: pd.Series, others: pd.Series) -> pd.Series:
        known: dict[str, tuple[set[int], set[int]]] = {}
        out = []
        for host, html, common, other in zip(hosts, htmls, commons, others, strict=True):
            if host not in known:
                known[host] = (set(), set()) if common is None else ({*common, *other}, set(common))
            out.append(main_text(html, *known[host]))
        return pd.Series(out, dtype=object)

    return joined.select(id_col, url_col, extract("_h", html_col, "common", "other").alias("text"))
