"""Main text of web pages by wrappers that are inferred per host.

A page is a token stream: blocks (elements that part text) and text. A block's group
is the path of marks that leads to it; a mark is a tag with its class words. Within
a group a page's children are folded: equal neighbours are a repeated group, and
children that come again after others make one repeated group of optional ones. The
streams of a host are aligned one after the other, along the longest common order of
the children of each group: what only some have is optional, what comes in another
order joins its neighbours in a repeated group, and differing texts are a slot. The
result is a union-free regular expression over tags, the host's wrapper.

All pages of a host take part. Tasks align their own pages, and partial wrappers are
aligned in two rounds, so that no task holds more than some hundred of a host. Fixed
texts are counted by the hash of the whole text per group over all pages, copies of
a page once. A page is then read along its host's wrapper: groups that are mostly
links and texts that the template holds go, in the article as well, and the slots
that are left are the text. What tags and class words still decide is listed with
the fixed values below.
"""

from __future__ import annotations

import html
import json
import re
import sys
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import small_arrow_batches, stored

FIXED_PAGES = 4          # a text is fixed, or a group a menu, by at least so many pages
FIXED = 0.5              # share of a group's pages that hold a fixed text
FIXED_PAGES_IN_ARTICLE = 8   # the same two inside an article
FIXED_IN_ARTICLE = 0.9
LINKED = 0.6             # share of link text from which a group is a menu
HELD_GROUPS = 200_000    # groups that a task holds before it passes wrappers on
ROUND = 256              # partial wrappers of a host, about, that one task aligns

#: Element names.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math",
       "xmp"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
          "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav",
          "ol", "p", "pre", "section", "summary", "table", "caption", "tbody", "thead", "tfoot",
          "tr", "td", "th", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NEVER = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option",
         "label", "input", "canvas", "object", "audio", "video"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = {"ul", "ol", "dl", "table", "select", "menu"}
#: What class names say of a block. SURE words say anywhere in a name
#: that it isn't of the article, STRONG ones as its head, and WEAK ones do so outside of
#: articles, but inside them only of groups of links and of fixed texts. Inline elements
#: and headings are never judged by names.
SURE = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "cookie",
        "cookies", "gdpr", "newsletter", "navbar", "breadcrumb", "breadcrumbs", "sidebar", "masthead",
        "commentlist", "disqus", "pagination", "popup", "modal", "outbrain", "taboola"}
STRONG = {"menu", "nav", "navigation", "footer", "share", "sharing", "social", "comment", "comments",
          "promo", "login", "signup", "subscribe", "consent", "pager", "toolbar"}
WEAK = {"banner", "side", "header", "notice", "notices", "overlay", "related", "recommended", "reply",
        "replies", "respond", "discussion", "widget", "copyright", "legal", "tags", "alert", "skip",
        "search", "teaser"}
MAIN_WORDS = {"article", "articlebody", "post", "entry", "story"}
#: Words behind the head of a name that leave its meaning: share-buttons, entry-content.
NEUTRAL = {"area", "articles", "bar", "block", "body", "box", "button", "buttons", "container", "content",
           "form", "icons", "inner", "item", "items", "link", "links", "list", "outer", "post", "posts",
           "section", "stories", "text", "thread", "widget", "widgets", "wrap", "wrapper"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
               "alert", "alertdialog", "menu", "menubar", "toolbar"}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
                    r"|</([a-zA-Z][^\s>/]*)[^>]*(?:>|$)"
                    r"|<([a-zA-Z][^\s>/]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|$)", re.S)
_ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_EMPTY = re.compile(r"(?:^|[\s\"'])/\s*$")       # else the slash ends a value
_CAMEL = re.compile(r"([a-z])([A-Z])")
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none")
_CLOSING = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(text, seed) >> 1


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def _heads(names: list[list[str]], known: set[str]) -> bool:
    """Whether a name's head is a known word: its last word, or its first if only
    neutral ones follow."""
    return any(n and (n[-1] in known or n[0] in known and NEUTRAL.issuperset(n[1:])) for n in names)


# --- one page ------------------------------------------------------------------

class Mark:
    """What a start tag says: its mark, whether the element never belongs to the
    article (``never``), does so by evidence only (``weak``), or is one (``main``)."""
    __slots__ = ("text", "never", "weak", "main")

    def __init__(self, tag: str, attrs: str):
        got = {}
        if attrs.strip("/ \t\r\n"):
            got = {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(attrs)}
        names = got.get("class", "").split()
        if tag not in ("p", "section", "article", "main"):   # there an id names a heading
            names += got.get("id", "").split()
        names = [_WORD.findall(_CAMEL.sub(r"\1 \2", n).lower()) for n in names]
        role = got.get("role", "").lower()
        judged = tag in BLOCKS and tag not in HEADINGS and tag not in ("html", "body")
        strong = judged and (any(SURE.intersection(n) for n in names) or _heads(names, STRONG))
        weak = judged and _heads(names, WEAK)
        own = tag in ("article", "main") or role in ("main", "article") \
            or "articlebody" in got.get("itemprop", "").lower() \
            or judged and _heads(names, MAIN_WORDS)
        self.main = own and not strong and not weak
        self.weak = weak
        self.never = tag in NEVER or strong or role in ASIDE_ROLES or "hidden" in got \
            or bool(_HIDDEN.search(got.get("style", "").lower()))
        self.text = tag + "".join("." + w for w in sorted({w for n in names for w in n})) \
            + ("@" + role if role else "")


_marks: dict[tuple[str, str], Mark] = {}


def _mark(tag: str, attrs: str) -> Mark:
    key = (tag, attrs)
    if key not in _marks:
        if len(_marks) > 50_000:
            _marks.clear()
        _marks[key] = Mark(tag, attrs)
    return _marks[key]


class Frame:
    """An open element: a block, a link, or an inline element whose text goes."""
    __slots__ = ("tag", "path", "block", "never", "weak", "main", "linked", "chars", "links", "kids")

    def __init__(self, tag, path, block, never, weak, main, linked):
        self.tag, self.path, self.block, self.never = tag, path, block, never
        self.weak, self.main, self.linked = weak, main, linked
        self.chars = self.links = 0
        self.kids: list[int] = []


# A group: mark, its parent's path, pages, how often it occurs, in how many of the
# parent's occurrences, characters, those in links, whether it is repeated by itself,
# and the order of its children: segments of paths, a repeated group if several.
MARK, PARENT, PAGES, TIMES, WITHIN, CHARS, LINK_CHARS, REPEATED, ORDER = range(9)
ROOT = 0


def read_page(page: str, menus=frozenset(), groups: dict[int, list] | None = None
              ) -> list[tuple[int, bool, bool, str]]:
    """(path, in an article, weak, text) of the blocks of a page that may belong to
    its article. ``menus`` are paths to leave out; ``groups`` collects the page's
    expression. Missing end tags are implied, stray ones dropped."""
    out: list[tuple[int, bool, bool, str]] = []
    stack = [Frame("#root", ROOT, True, False, False, False, False)]
    blocks = stack[:]
    opened: dict[str, int] = {}
    words: list[str] = []
    if groups is not None:
        groups[ROOT] = ["#root", ROOT, 1, 1, 1, 0, 0, False, []]

    def flush() -> None:
        if words:
            text = _squeeze("".join(words))
            words.clear()
            if text:
                out.append((blocks[-1].path, blocks[-1].main, blocks[-1].weak, text))

    def pop(upto: int) -> None:
        while len(stack) > upto:
            frame = stack[-1]
            if frame.block:
                flush()
                blocks.pop()
            stack.pop()
            opened[frame.tag] -= 1
            stack[-1].chars += frame.chars
            stack[-1].links += frame.links
            if groups is not None and frame.block:
                _close(groups, frame)

    def put(text: str) -> None:
        top = stack[-1]
        if top.never:
            return
        words.append(text)
        top.chars += len(text)
        if top.linked:
            top.links += len(text)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            put(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        end, start, attrs = m.group(1), m.group(2), m.group(3)
        if start:
            tag = start.lower()
            if tag in RAW:
                if tag not in ("svg", "math") or not attrs.rstrip().endswith("/"):
                    close = _CLOSING[tag].search(page, at)
                    at = close.end() if close else size
                continue
            if tag == "br":
                put(" ")
                continue
            block = tag in BLOCKS
            if block:
                flush()
                for k in range(len(stack) - 1, 0, -1):      # a block ends an open paragraph
                    if stack[k].tag == "p":
                        pop(k)
                        break
                    if stack[k].block:
                        break
            if tag in CLOSES and any(opened.get(t) for t in CLOSES[tag]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in CLOSES[tag]:
                        pop(k)
                        if tag != "tr":
                            break
                    elif stack[k].tag in LISTS:
                        break
            if tag == "a" and stack[-1].tag == "a":
                pop(len(stack) - 1)
            if tag in VOID:
                continue
            mark, top = _mark(tag, attrs or ""), stack[-1]
            if not block and tag != "a" and not mark.never:
                continue                                     # inline: its text flows on
            path = _hash(mark.text, top.path) if block else top.path
            main = top.main or mark.main
            never = top.never or mark.never or (block and path in menus) or (
                tag == "header" and not main) or (block and mark.weak and not main)
            if _EMPTY.search(attrs or ""):
                continue
            frame = Frame(tag, path, block, never, block and (top.weak or mark.weak), main,
                          top.linked or tag == "a")
            if block and groups is not None:
                if path not in groups:
                    groups[path] = [mark.text, top.path, 1, 0, 0, 0, 0, False, []]
                blocks[-1].kids.append(path)
            stack.append(frame)
            if block:
                blocks.append(frame)
            opened[tag] = opened.get(tag, 0) + 1
        elif end:
            tag = end.lower()
            if opened.get(tag):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        pop(k)
                        break
                    # an inline end tag does not reach past its block
                    if stack[k].block and tag not in BLOCKS:
                        break
        elif m.group(0).startswith("<![CDATA["):
            put(re.sub(r"\]\]>$", "", m.group(0)[9:]))
    pop(1)
    flush()
    if groups is not None:
        _close(groups, stack[0])
    return out


def _close(groups: dict[int, list], frame: Frame) -> None:
    g = groups[frame.path]
    if frame.path != ROOT:
        g[TIMES] += 1
    g[CHARS] += frame.chars
    g[LINK_CHARS] += frame.links
    before = None
    for kid in frame.kids:
        if kid == before:
            groups[kid][REPEATED] = True
        before = kid
    for kid in set(frame.kids):
        groups[kid][WITHIN] += 1
    g[ORDER] = align(g[ORDER], fold(frame.kids))


# --- expressions -----------------------------------------------------------------

def fold(kids: list[int]) -> list[list[int]]:
    """Children in their order, equal neighbours as one; a stretch in which some come
    again after others is one segment."""
    order = [k for n, k in enumerate(kids) if n == 0 or kids[n - 1] != k]
    last = {k: n for n, k in enumerate(order)}
    out: list[list[int]] = []
    held: set[int] = set()
    end = -1
    for n, k in enumerate(order):
        if n > end:
            out.append([])
            held = set()
        if k not in held:
            held.add(k)
            out[-1].append(k)
        end = max(end, last[k])
    return out


def _rising(values: list[int]) -> list[int]:
    """Places of a longest rising subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back = []
    for n, v in enumerate(values):
        k = bisect_left(tails, v)
        back.append(ends[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            ends.append(n)
        else:
            tails[k], ends[k] = v, n
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(n)
        n = back[n]
    return out[::-1]


def align(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    """One order of segments for two. Segments that share children match along the
    longest common order, and what only one has stays in its place; one that matches
    against that order, or several of the other, joins all between in one segment."""
    if not a or not b or a == b:
        return a or b
    place = {k: n for n, s in enumerate(a) for k in s}
    meets = [[place[k] for k in s if k in place] for s in b]
    met = [(min(m), max(m)) for m in meets if m]
    anchors = _rising([lo for lo, _ in met])
    reach = list(range(len(a)))             # the last segment that each is joined with
    for n, (lo, hi) in enumerate(met):
        k = bisect_left(anchors, n)
        if k == len(anchors) or anchors[k] != n:     # against the order of a neighbour
            sides = [met[x][0] for x in anchors[max(k - 1, 0):k + 1]]
            if k and lo < sides[0]:
                hi = max(hi, sides[0])
            elif lo > sides[-1]:
                lo = sides[-1]
        reach[lo] = max(reach[lo], hi)
    out: list[list[int]] = []
    owner, end = [], -1
    for n, segment in enumerate(a):
        if n > end:
            out.append([])
        out[-1] += segment
        owner.append(len(out) - 1)
        end = max(end, reach[n])
    behind: dict[int, list[list[int]]] = {}  # what only b has, by the segment before it
    here = -1
    for segment, m in zip(b, meets, strict=True):
        if m:
            here = owner[min(m)]
            out[here] += [k for k in segment if k not in place]
        else:
            behind.setdefault(here, []).append(list(segment))
    return [*behind.get(-1, []), *(s for n, own in enumerate(out)
                                   for s in [own, *behind.get(n, [])])]


def merged(a: dict[int, list], b: dict[int, list]) -> dict[int, list]:
    """The expression of both sets of pages; ``a`` is changed."""
    for path, g in b.items():
        held = a.get(path)
        if held is None:
            a[path] = g
            continue
        for n in (PAGES, TIMES, WITHIN, CHARS, LINK_CHARS):
            held[n] += g[n]
        held[REPEATED] = held[REPEATED] or g[REPEATED]
        held[ORDER] = align(held[ORDER], g[ORDER])
    return a


def infer(pages: list[str]) -> dict[int, list]:
    """The wrapper of pages of a host, aligned one after the other."""
    wrapper: dict[int, list] = {}
    for page in pages:
        groups: dict[int, list] = {}
        read_page(page, groups=groups)
        wrapper = merged(wrapper, groups)
    return wrapper


def expression(wrapper: dict[int, list]) -> str:
    """The wrapper as a regular expression over tags; # is a text slot."""
    if ROOT not in wrapper:
        return ""
    out: list[str] = []
    todo: list = [ROOT]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        g = wrapper[x]
        optional = g[WITHIN] < wrapper[g[PARENT]][TIMES]
        sign = ("*" if optional else "+") if g[REPEATED] else "?" * optional
        out.append(f"(<{g[MARK]}>" if sign else f"<{g[MARK]}>")
        if g[CHARS] and not g[ORDER]:
            out.append("#")
        todo.append(f"</>){sign}" if sign else "</>")
        for segment in reversed(g[ORDER]):
            if len(segment) > 1:
                todo += [")+", *reversed(segment), "("]
            else:
                todo += segment
    return "".join(out)


def menus_of(wrapper: dict[int, list], least: int = FIXED_PAGES) -> list[int]:
    """Groups that are mostly links: menus outside of articles."""
    return sorted(p for p, g in wrapper.items() if p != ROOT and g[CHARS] > 0
                  and g[MARK].split(".")[0].split("@")[0] not in ("html", "body")
                  and g[LINK_CHARS] >= LINKED * g[CHARS] and g[PAGES] >= min(
                      least, wrapper[ROOT][PAGES]))


def extract(page: str, menus=frozenset(), fixed=frozenset(), fixed_in_article=frozenset()) -> str:
    """The article of a page, blocks parted by an empty line. ``fixed`` and
    ``fixed_in_article`` hold ``slot(path, text)`` of the host's fixed texts.

    Where a page has articles only they count, and a menu group inside one goes only
    if a class name says so as well. A page whose texts are all fixed keeps them: it
    can't be told from its copies."""
    blocks = read_page(page)
    if not any(main for _, main, _, _ in blocks):
        blocks = read_page(page, menus)
        left = [text for path, _, _, text in blocks if slot(path, text) not in fixed]
        return "\n\n".join(left or [text for _, _, _, text in blocks])
    blocks = [b for b in blocks if b[1]]
    left = [text for path, _, weak, text in blocks
            if slot(path, text) not in (fixed if weak else fixed_in_article)
            and not (weak and path in menus)]
    return "\n\n".join(left or [text for _, _, _, text in blocks])


def slot(path: int, text: str) -> int:
    """A text in its group, as a number."""
    return _hash(text, path)


# --- all pages of all hosts --------------------------------------------------------

def host(url: Column) -> Column:
    """Host of a URL in lower case; empty for none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)),
                      F.lit(""))


def _dumped(wrapper: dict[int, list]) -> str:
    return json.dumps(list(wrapper.items()))


def _loaded(text: str) -> dict[int, list]:
    return dict(json.loads(text))


_PARTIAL = "host string, part long, wrapper string"


def _aligned(table: pa.Table) -> pa.Table:
    """Partial wrappers of a host as one."""
    wrapper: dict[int, list] = {}
    for text in sorted(table.column("wrapper").to_pylist()):
        wrapper = merged(wrapper, _loaded(text))
    return pa.table({"host": table.column("host").slice(0, 1),
                     "part": pa.array([table.column("part")[0].as_py() // ROUND], pa.int64()),
                     "wrapper": [_dumped(wrapper)]})


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, expression, menus): the wrapper of each host, inferred from all its
    pages, and its groups that are mostly links."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[str, dict[int, list]] = {}

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([part] * len(held), pa.int64()),
                 pa.array([_dumped(w) for w in held.values()])], names=["host", "part", "wrapper"])

        size = 0
        for b in batches:
            for name, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                groups: dict[int, list] = {}
                read_page(page or "", groups=groups)
                wrapper = held.setdefault(name, {})
                size -= len(wrapper)
                size += len(merged(wrapper, groups))
                if size > HELD_GROUPS:
                    yield passed()
                    held.clear()
                    size = 0
        if held:
            yield passed()

    def finish(table: pa.Table) -> pa.Table:
        wrapper = _loaded(_aligned(table).column("wrapper")[0].as_py())
        return pa.table({"host": table.column("host").slice(0, 1),
                         "expression": [expression(wrapper)],
                         "menus": pa.array([menus_of(wrapper)], pa.list_(pa.int64()))})

    small_arrow_batches(pages.sparkSession)
    partial = pages.select(host(F.col(url_col)).alias("host"), html_col).mapInArrow(learn, _PARTIAL)
    some = partial.groupBy("host", F.floor(F.col("part") / ROUND)).applyInArrow(_aligned, _PARTIAL)
    return some.groupBy("host").applyInArrow(
        finish, "host string, expression string, menus array<long>")


def fixed_texts(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, fixed, fixed_in_article): the slots whose text most pages of the host
    with the group hold. Pages of the same blocks count once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for name, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                blocks = read_page(page or "")
                whole = _hash("\n".join(f"{p} {t}" for p, _, _, t in blocks))
                rows += [(name, whole, p, slot(p, t)) for p, t in {(p, t) for p, _, _, t in blocks}]
            if rows:
                names, *numbers = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), *(pa.array(n, pa.int64()) for n in numbers)],
                    names=["host", "page", "path", "slot"])

    small_arrow_batches(pages.sparkSession)
    # copies of a page meet here; a hot host's rows lie apart by page and slot
    seen = (pages.select(host(F.col(url_col)).alias("host"), html_col)
            .mapInArrow(run, "host string, page long, path long, slot long").distinct())
    seen = stored(seen, "wrapper-slots")
    in_path = seen.select("host", "path", "page").distinct().groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"))
    often = (seen.groupBy("host", "path", "slot").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= FIXED_PAGES).join(in_path, ["host", "path"])
             .where(F.col("n") >= FIXED * F.col("pages")))
    return often.groupBy("host").agg(
        F.collect_list("slot").alias("fixed"),
        F.collect_list(F.when((F.col("n") >= FIXED_IN_ARTICLE * F.col("pages"))
                              & (F.col("n") >= FIXED_PAGES_IN_ARTICLE), F.col("slot"))
                       ).alias("fixed_in_article"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (the article, empty if none).

    Null html counts as empty; pages without a URL are a host of their own; null
    and repeated ids and repeated rows are kept; an empty table gives none; other
    columns are ignored; nesting may be as deep and blocks as many as they are."""
    # stored, so that Spark knows their size and need not shuffle pages if it is small
    learnt = stored(wrappers(pages, url_col, html_col).join(
        fixed_texts(pages, url_col, html_col), "host", "left"), "wrappers")
    small_arrow_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"), host(F.col(url_col)).alias("host"))
    kind = pages.schema[id_col].dataType.simpleString()
    known = ["menus", "fixed", "fixed_in_article"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, list[frozenset]] = {}
        for b in batches:
            out = []
            for k, (name, page) in enumerate(zip(b.column("host").to_pylist(),
                                                 b.column("html").to_pylist(), strict=True)):
                if name not in sets:
                    if len(sets) > 500:
                        sets.clear()
                    sets[name] = [frozenset(b.column(c)[k].as_py() or ()) for c in known]
                out.append(extract(page or "", *sets[name]))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"),
                                              pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    return (rows.join(learnt.drop("expression"), "host", "left")
            .select("page_id", "url", "host", "html", *known)
            .mapInArrow(run, f"page_id {kind}, url string, text string"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
