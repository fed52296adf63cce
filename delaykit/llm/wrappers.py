"""Main text of HTML pages by wrapper induction: same-host pages are aligned by simple tree matching.

1. Every page is parsed into a tree of block elements and the text blocks in it (inline elements and character references
   resolved, scripts, styles and comments gone).  Adjacent siblings of one shape are one repeated node.
2. Pages of a host whose trees agree on the upper levels are a class; its smallest tree is the wrapper.  Each page's tree is
   aligned with the wrapper by simple tree matching (the largest top-down, order-keeping match of equal labels), which gives
   every block its slot.
3. A slot's text that ``CONSTANT`` of the class's different pages (three at least) share is template; all other slots vary.
   Counting different pages, by their longest block, keeps an article that many copies repeat from being called template.
   In classes without an article element, slots whose text is nearly all links are menus.
4. Content are the varying blocks outside elements whose tag, role, class or id says that they are no main text (the fixed
   lists below): within article elements if one holds text, else within main, else in the body.

No page moves through a shuffle, only trees and hashes of blocks do, and no task holds a host: votes are counted per
(class, slot, text), and a hot host's rows meet its wrapper by broadcast (if the wrappers' bytes are within a bound) or in a
join salted by row.

Results: null and empty pages, and pages without main text, have the empty text; pages without a host in the URL, or alone in
their class, are judged by their own elements only; repeated rows and null ids are rows like any other and repeated pages
vote once; extra columns are ignored; an empty table gives no rows.  Elements nested deeper than 200 levels count as
siblings on that level; lists of over 500 unlike siblings are aligned in stretches.
"""

from __future__ import annotations

import functools
import html
import re
from collections import defaultdict

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import broadcast_within, map_rows
from delaykit.session import materialize

CONSTANT, MIN_PAGES, LINKED = 0.8, 3, 0.8
MAX_DEPTH, STRETCH, SALTS, WRAPPER_BYTES = 200, 500, 32, 32 << 20

# HTML's elements without content, with raw text, and those that stand as blocks of their own.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe noembed noframes textarea title xmp svg math".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select
    summary table tbody td tfoot th thead tr ul""".split())
# What a start tag ends, and where the search for it stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
        "option": ({"option"}, {"select"}), "optgroup": ({"optgroup"}, {"select"})}
# Elements, roles and words of a class or id that mark what is no main text.
SIDE_TAGS = set("""aside button canvas datalist dialog footer form head header input label map menu nav object search
    select audio video""".split())
SIDE_ROLES = set("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    toolbar""".split())
SIDE_WORDS = set("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-share comment comments
    commentlist consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
    notice notices pager pagination paywall popup promo promoted promotion related respond search share sharing sidebar signup
    skip social sponsor sponsored subscribe subscription toolbar topbar widget""".split())
IN_ARTICLE = {"header", "banner", "masthead"}  # an article's own header holds its headline

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                 r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[a-z]+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _side(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in ("html", "body", "article", "main") and not ("hidden" in attrs):
        words = set(WORD.findall(attrs.get("class", "").lower())) if tag == "article" else set()
        return bool(words & {"comment", "comments"})
    found = {tag} & SIDE_TAGS | set(attrs.get("role", "").lower().split()) & SIDE_ROLES
    found |= set(WORD.findall((attrs.get("class", "") + " " + attrs.get("id", "")).lower())) & SIDE_WORDS
    if in_article:
        found -= IN_ARTICLE
    style = attrs.get("style", "").replace(" ", "").lower()
    return bool(found) or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style


class Open:
    """An open element; ``place``: 0 body, 1 main, 2 article; ``inner`` / ``outer``: no main text below / above that."""
    __slots__ = ("tag", "node", "depth", "place", "inner", "outer", "link")

    def __init__(self, tag, node, depth, place, inner, outer, link):
        self.tag, self.node, self.depth = tag, node, depth
        self.place, self.inner, self.outer, self.link = place, inner, outer, link


class Page:
    """Block tree (``labels``, ``parents``) and text blocks (node, text, characters in links, place, inner, outer)."""

    def __init__(self, source: str):
        self.labels, self.parents, self.blocks = ["html"], [-1], []
        self.stack = [Open("html", 0, 0, 0, False, False, False)]
        self.open_tags: dict[str, int] = defaultdict(int)
        self.pieces: list[tuple[str, bool]] = []
        at, end = 0, len(source)
        while at < end:
            m = TAG.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._end(tag)
            elif tag in RAW:
                close = re.compile(f"</{tag}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(source, at)
                at = close.end() if close else end
            else:
                self._start(tag, m[3] if m[2] else m[6])
        self._flush()

    def _text(self, text: str) -> None:
        self.pieces.append((html.unescape(text) if "&" in text else text, self.stack[-1].link))

    def _flush(self) -> None:
        """The text since the last block boundary is a block of the innermost open block element."""
        if not self.pieces:
            return
        text = " ".join("".join(t for t, _ in self.pieces).split())
        if text:
            top = self.stack[-1]
            linked = sum(len(" ".join(t.split())) for t, link in self.pieces if link)
            self.blocks.append((top.node, text, min(linked, len(text)), top.place, top.inner, top.outer))
        self.pieces = []

    def _pop(self) -> None:
        if self.stack[-1].tag in BLOCK or self.stack[-1].inner != self.stack[-2].inner:
            self._flush()
        self.open_tags[self.stack.pop().tag] -= 1

    def _pop_to(self, tag: str) -> None:
        while self.stack[-1].tag != tag:
            self._pop()
        self._pop()

    def _start(self, tag: str, attr_text: str) -> None:
        if tag in ("html", "body", "head"):
            return
        if tag == "br" or tag == "wbr":
            if tag == "br":
                self.pieces.append((" ", False))
            return
        block = tag in BLOCK
        if block and self.open_tags["p"] and tag not in ("option", "optgroup", "select", "legend", "summary"):
            self._pop_to("p")
        if tag in ENDS:
            closed, stop = ENDS[tag]
            if any(self.open_tags[c] for c in closed):
                for element in reversed(self.stack[-64:]):
                    if element.tag in closed:
                        self._pop_to(element.tag)
                        break
                    if element.tag in stop:
                        break
        if tag == "a" and self.stack[-1].tag == "a":
            self._pop()
        if tag in VOID:
            if block:
                self._flush()
            return
        top, attrs = self.stack[-1], _attributes(attr_text)
        place, inner, outer = top.place, top.inner, top.outer
        role = attrs.get("role", "").lower()
        if tag == "article" or attrs.get("itemprop", "").lower() == "articlebody":
            place, inner, outer = 2, inner and place == 2, outer or inner
        elif (tag == "main" or role == "main") and place == 0:
            place, inner, outer = 1, False, outer or inner
        inner = inner or _side(tag, attrs, place == 2)
        node, depth = top.node, top.depth
        if block or inner != top.inner:
            self._flush()
        if block:
            words = sorted(set(WORD.findall(attrs.get("class", "").lower())))
            if depth >= MAX_DEPTH:
                node = self.parents[node]
            else:
                depth += 1
            self.labels.append(".".join([tag, *words]))
            self.parents.append(node)
            node = len(self.labels) - 1
        self.stack.append(Open(tag, node, depth, place, inner, outer, top.link or tag == "a"))
        self.open_tags[tag] += 1

    def _end(self, tag: str) -> None:
        if tag == "br":
            self.pieces.append((" ", False))
        if not self.open_tags[tag]:
            return
        if tag in BLOCK:
            self._pop_to(tag)
            return
        for element in reversed(self.stack[-64:]):  # an inline end tag closes nothing outside its block
            if element.tag == tag:
                self._pop_to(tag)
                return
            if element.tag in BLOCK:
                return

    def content(self) -> tuple[list[bool], bool]:
        """Which blocks may be main text by their elements, and whether they were found without article or main."""
        for place, within in ((2, False), (1, False), (2, True), (1, True)):
            keep = [b[3] >= place and not b[4] and (within or not b[5]) for b in self.blocks]
            if any(keep):
                return keep, False
        return [not b[4] and not b[5] for b in self.blocks], True

    def skeleton(self) -> tuple[list[tuple[int, str]], list[int]]:
        """The tree in preorder as (depth, label), adjacent siblings of one shape as one node; and the node of each block.
        Nodes without text are left out."""
        full = [False] * len(self.labels)
        for b in self.blocks:
            full[b[0]] = True
        children: list[list[int]] = [[] for _ in self.labels]
        for node in range(len(self.labels) - 1, 0, -1):
            if full[node]:
                full[self.parents[node]] = True
        for node in range(1, len(self.labels)):
            if full[node]:
                children[self.parents[node]].append(node)
        shape, known = [0] * len(self.labels), {}
        groups: list[list[list[int]]] = [[] for _ in self.labels]  # children by stretches of one shape
        for node in range(len(self.labels) - 1, -1, -1):
            if full[node]:
                for c in children[node]:
                    if groups[node] and shape[groups[node][-1][0]] == shape[c]:
                        groups[node][-1].append(c)
                    else:
                        groups[node].append([c])
                shape[node] = known.setdefault((self.labels[node], tuple(shape[g[0]] for g in groups[node])), len(known))
        out: list[tuple[int, str]] = []
        number = [-1] * len(self.labels)
        todo = [(0, 0, -1)]  # (node, depth, the earlier node of one shape that it counts as)
        while todo:
            node, depth, twin = todo.pop()
            if twin < 0:
                number[node] = len(out)
                out.append((depth, self.labels[node]))
            else:
                number[node] = number[twin]
            below = []
            for k, members in enumerate(groups[node]):
                first = members[0] if twin < 0 else groups[twin][k][0]
                below += [(c, depth + 1, -1 if c == first else first) for c in members]
            todo += reversed(below)
        return out, [number[b[0]] for b in self.blocks]


@functools.lru_cache(4096)
def _tree(skeleton: str) -> tuple[tuple[str, ...], tuple[tuple[int, ...], ...]]:
    labels, children, path = [], [], []
    for number, line in enumerate(skeleton.split("\n")):
        depth, label = line.split(" ", 1)
        labels.append(label)
        children.append([])
        del path[int(depth):]
        if path:
            children[path[-1]].append(number)
        path.append(number)
    return tuple(labels), tuple(map(tuple, children))


@functools.lru_cache(8192)
def align(skeleton: str, wrapper: str) -> tuple[int, ...]:
    """Simple tree matching: for each node of the skeleton its slot, the wrapper's node matched with it, or -1."""
    if skeleton == wrapper:
        return tuple(range(skeleton.count("\n") + 1))
    (labels, children), (w_labels, w_children) = _tree(skeleton), _tree(wrapper)
    slots, memo = [-1] * len(labels), {}

    def weight(a: int, b: int) -> int:
        if labels[a] != w_labels[b]:
            return 0
        if (a, b) not in memo:
            memo[a, b] = 1 + table(children[a], w_children[b])[-1][-1]
        return memo[a, b]

    def stretches(left, right):
        parts = max(1, -(-max(len(left), len(right)) // STRETCH))
        for k in range(parts):
            yield (left[len(left) * k // parts:len(left) * (k + 1) // parts],
                   right[len(right) * k // parts:len(right) * (k + 1) // parts])

    def table(left, right):
        """Best weights of the first i nodes against the first j; of long lists the sum over their stretches."""
        if max(len(left), len(right)) > STRETCH:
            return [[sum(table(x, y)[-1][-1] for x, y in stretches(left, right))]]
        rows = [[0] * (len(right) + 1)]
        for a in left:
            row = [0]
            for j, b in enumerate(right):
                row.append(max(row[j], rows[-1][j + 1], rows[-1][j] + weight(a, b)))
            rows.append(row)
        return rows

    todo = [(0, 0)] if labels[0] == w_labels[0] else []
    while todo:
        a, b = todo.pop()
        slots[a] = b
        for left, right in stretches(children[a], w_children[b]):
            rows, i, j = table(left, right), len(left), len(right)
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((left[i], right[j]))
    return tuple(slots)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def parse(page_id, url, host, source) -> tuple:
    """A row of the parsed table; ``kind`` tells page classes apart by the labels of the two levels below the root."""
    page = Page(source or "")
    keep, free = page.content()
    tree, nodes = page.skeleton()
    upper, path = set(), []
    for depth, label in tree:
        del path[depth:]
        path.append(label)
        if depth <= 2:
            upper.add("/".join(path))
    chars, links = defaultdict(int), defaultdict(int)
    for node, b in zip(nodes, page.blocks):
        chars[node] += len(b[1])
        links[node] += b[2]
    blocks = [{"node": node, "text": b[1], "links": b[2], "linked": links[node] >= LINKED * chars[node]}
              for node, b, k in zip(nodes, page.blocks, keep) if k]
    longest = max((b[1] for b, k in zip(page.blocks, keep) if k), key=lambda t: (len(t), t), default="")
    return (page_id, url, host, _hash("\n".join(sorted(upper))), "\n".join(f"{d} {label}" for d, label in tree), len(tree),
            free, _hash(longest), blocks)


_PARSED = ("page_id long, url string, host string, kind long, skeleton string, nodes int, free boolean, main long, "
           "blocks array<struct<node:int,text:string,links:int,linked:boolean>>")
_VOTES = "host string, kind long, pages long, main long, blocks array<struct<slot:int,text:long,chars:long,links:long>>"


def wrappers(parsed: DataFrame) -> DataFrame:
    """One row per class (``host``, ``kind``): its ``wrapper``, the hashes of its ``template`` texts as (slot, text) and the
    slots that are ``menus``."""
    hosted = parsed.filter("host IS NOT NULL")
    chosen = hosted.groupBy("host", "kind").agg(
        F.min_by("skeleton", F.struct("nodes", "skeleton")).alias("wrapper"), F.count_distinct("main").alias("pages"))
    chosen = chosen.filter(F.col("pages") >= MIN_PAGES)
    rows = _with_class(hosted.select("host", "kind", "skeleton", "main", "blocks"), chosen, "inner")

    def vote(host, kind, skeleton, main, blocks, wrapper, pages):
        slots, sums = align(skeleton, wrapper), defaultdict(lambda: [0, 0])
        for b in blocks:
            if slots[b["node"]] >= 0:
                own = sums[slots[b["node"]], _hash(b["text"])]
                own[0] += len(b["text"])
                own[1] += b["links"]
        return host, kind, pages, main, [{"slot": s, "text": t, "chars": c, "links": n} for (s, t), (c, n) in sums.items()]

    votes = map_rows(rows.select("host", "kind", "skeleton", "main", "blocks", "wrapper", "pages"), vote, _VOTES)
    chars, links = F.max("chars").alias("chars"), F.max("links").alias("links")
    per_page = votes.select("host", "kind", "pages", "main", F.inline("blocks")).groupBy(
        "host", "kind", "pages", "slot", "text", "main").agg(chars, links)
    chars, links = F.sum("chars").alias("chars"), F.sum("links").alias("links")
    per_text = per_page.groupBy("host", "kind", "pages", "slot", "text").agg(F.count(F.lit(1)).alias("votes"), chars, links)
    constant = F.col("votes") >= F.greatest(F.lit(MIN_PAGES), F.ceil(F.col("pages") * CONSTANT))
    per_slot = per_text.groupBy("host", "kind", "slot").agg(F.collect_set(F.when(constant, F.col("text"))).alias("texts"), chars, links)
    marked = F.transform("texts", lambda t: F.struct(F.col("slot").alias("slot"), t.alias("text")))
    slots = per_slot.groupBy("host", "kind").agg(
        F.flatten(F.collect_list(marked)).alias("template"),
        F.collect_list(F.when(F.col("links") >= LINKED * F.col("chars"), F.col("slot"))).alias("menus"))
    return chosen.select("host", "kind", "wrapper").join(slots, ["host", "kind"], "left")


def _with_class(rows: DataFrame, classes: DataFrame, how: str) -> DataFrame:
    """Rows with their class: broadcast if the classes are small in bytes, else joined on a salt as well."""
    small = broadcast_within(classes, WRAPPER_BYTES)
    if small is not None:
        return rows.join(small, ["host", "kind"], how)
    salted = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("main", "skeleton"), F.lit(SALTS)).cast("int")).join(
        salted, ["host", "kind", "salt"], how).drop("salt")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id``, ``url``, main ``text`` (blocks by line feeds) and ``n_chars``."""
    given = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                         pages[html_col].cast("string").alias("html"))
    host = F.lower(F.nullif(F.try_parse_url("url", F.lit("HOST")), F.lit("")))
    parsed = materialize(map_rows(given.select("page_id", "url", host.alias("host"), "html"), parse, _PARSED), "parsed")
    classes = materialize(wrappers(parsed), "wrappers")

    def main_text(page_id, url, skeleton, free, blocks, wrapper, template, menus):
        slots = align(skeleton, wrapper) if wrapper is not None else None
        gone, listed = {(t["slot"], t["text"]) for t in template or ()}, set(menus or ())
        kept = []
        for b in blocks:
            slot = slots[b["node"]] if slots else -1
            menu = free and (slot in listed if slot >= 0 else b["linked"])
            if not menu and not (gone and (slot, _hash(b["text"])) in gone):
                kept.append(b["text"])
        text = "\n".join(kept)
        return page_id, url, text, len(text)

    rows = _with_class(parsed, classes, "left")
    return map_rows(rows.select("page_id", "url", "skeleton", "free", "blocks", "wrapper", "template", "menus"), main_text,
                    "page_id long, url string, text string, n_chars long")
