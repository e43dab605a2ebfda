"""HTML extraction with wrappers inferred by union-free regular expressions.

A page is a stream of block tags and texts.  Tandem repeats in it are folded
into repeated groups, and the streams of a host's pages are aligned one after
the other: what only some pages have becomes an optional group, a text that
differs becomes a slot, and a text that stays the same is part of the template.
On a host with at least ``MANY`` different pages the wrapper decides:

* template texts, which nearly all (``NEARLY``) pages have on the same tag path, counted over
  all pages, are cut, inside ``article`` and ``main`` too.  If they are most of the texts
  (``ALIKE``), the pages are near copies of each other and nothing is cut.  A
  heading of the template inside ``article`` or ``main`` goes with what it heads: it stays if the next text of
  its parent element is a slot ("References"), and is cut otherwise;
* a class, id or role word that names something else is overruled if, on nearly all pages that have slots,
  all slots lie inside the element: it is a frame around the main text (``with-sidebar``), not the
  thing that the word names;
* a word that also names parts of an article (``DOUBTFUL``) is taken at its word if the streams of the
  host, aligned by their repeated groups, show a repeated group of items inside the element (a list of posts), and
  is overruled if not: a page that repeats the items there says so, and so does one with a single item that another
  page of the host repeats.

Elements that HTML itself keeps for other things (navigation, headers, footers, forms, asides) never hold main
text, and neither does what lies in an element that words mark and no slot pattern clears: a reader comment differs
from page to page like the article does, so only its name tells.  Of all other texts, those in an
``article`` or ``main`` element are main text if the page has one; on other pages, all are.  On
hosts with fewer pages, the words alone decide.

Nothing is sampled: every different page of a host is read, folded and counted.  Copies of a page count once.  Pages are
read in one pass, in time linear in their length, and a tag path is a node with a link to its parent.

Nulls: a null page is empty and has no text; a null url or one without a host
belongs to a host of its own.  Malformed markup (open elements, stray end tags,
unclosed comments, tags and quotes) is read as far as it goes.  Repeated rows are read alike,
and an empty table gives an empty result.  Columns with the names of the output
columns are replaced, and all others pass through.
"""

from __future__ import annotations

import difflib
import html
import json
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.common import add_columns, slices, table, without, written

#: Different pages that a template needs; part of them that its texts are on; part of all texts from which on pages are near copies.
MANY, NEARLY, ALIKE = 5, 0.95, 0.8
#: Bytes of all wrappers up to which they are broadcast; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
#: Tokens of the longest repeated group.
LONGEST = 12
#: Forms whose repeated groups a task remembers.
FORMS = 10_000
#: Marked elements inside each other that may be overruled; what lies deeper stays cut.
DEPTH = 8

BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td "
    "template textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("br hr".split())
ASIDE = frozenset("head title nav header footer aside form noscript template iframe button select textarea menu dialog option label search".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices sidebar nav navbar navigation menu "
    "breadcrumb breadcrumbs footer masthead header comment comments replies discussion related share sharing social newsletter subscribe subscription signup popup modal "
    "widget pagination pager toolbar contentinfo complementary search".split()
)
#: Words of these that parts of an article have, too.
DOUBTFUL = frozenset(["discussion", "header"])
#: Elements that a repeated item of a list of posts starts with.
ITEMS = frozenset("li article div section blockquote dl dd tr details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a start tag of the key ends, when they are open.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements beyond which such an end doesn't reach.
BOUNDS = frozenset("ul ol dl table body select article main section div nav".split())

#: A comment, declaration or tag begins.
OPENS = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
#: Ends a tag or opens a quote in it.
STOPS = re.compile(r"[>\"']")
#: Elements whose content is no markup, and what ends it.
RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "svg", "math")}
NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[a-z]+")


class Path:
    """An open element: its name, its parent and what both say about the texts inside."""

    __slots__ = ("depth", "hard", "key", "kids", "main", "marks", "maybe", "name", "up")

    def __init__(self, name: str = "", up: Path | None = None):
        self.name, self.up, self.kids = name, up, {}
        if up is None:
            self.depth, self.key, self.hard, self.main, self.marks, self.maybe = 0, 0, False, False, (), ()
            return
        self.depth, self.key = up.depth + 1, xxhash.xxh3_64_intdigest(f"{up.key:x}/{name}") >> 1
        tag = plain(name)
        self.hard = up.hard or tag in ASIDE and not (tag == "header" and up.main)  # an article's header holds the title
        self.main = up.main or tag in ("article", "main") or name.endswith("=main")
        self.marks, self.maybe = up.marks, up.maybe
        if name.endswith("?") and up.main:
            self.maybe = (*up.maybe, self.key)
        elif name[-1:] in "!?":
            self.marks = (*up.marks, self.key) if len(up.marks) < DEPTH else (*up.marks[:DEPTH], -1)

    def kid(self, name: str) -> Path:
        found = self.kids.get(name)
        if found is None:
            found = self.kids[name] = Path(name, self)
        return found

    def kind(self) -> int:
        """0: never main text, 1: main text if there is no main element, 2: in a main element, 3: in a marked element."""
        return 0 if self.hard else 3 if self.marks else 2 if self.main else 1

    def within(self, other: Path) -> bool:
        at = self
        while at.depth > other.depth:
            at = at.up
        return at is other


def plain(name: str) -> str:
    return name.rstrip("!?").removesuffix("=main")


def element(name: str, attributes: str) -> str:
    """Name of an open element, with a mark if its class, id or role tells that it is not main text ("?": perhaps not)."""
    words = {w for m in NAMED.finditer(attributes) for v in m.groups()[1:] if v for w in PARTS.findall(v.lower())} if attributes else set()
    if (found := words & ASIDE_WORDS) and name not in ("html", "body"):
        return f"{name}!" if found - DOUBTFUL else f"{name}?"
    return f"{name}=main" if "main" in words and "role" in attributes.lower() else name


def tag_end(page: str, at: int) -> int:
    """Where the ">" of a tag is: outside quotes, or the first one if a quote never ends; -1 if there is none."""
    while m := STOPS.search(page, at):
        if m[0] == ">":
            return m.start()
        close = page.find(m[0], m.end())
        if close < 0:
            return page.find(">", m.end())
        at = close + 1
    return -1


def read(page: str) -> list[tuple[str, str, Path]]:
    """Stream of a page: (token, text, path), with text for the token ``#`` only."""
    out: list[tuple[str, str, Path]] = []
    here = Path()
    open_: dict[str, list[Path]] = {}  # open elements by plain name, innermost last
    text: list[str] = []
    at, quotes, last = 0, True, page.rfind(">")

    def flush() -> None:
        if text:
            said = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if said:
                out.append(("#", said, here))

    def close(to: Path) -> None:
        nonlocal here
        flush()
        while here is not to:
            out.append(("/" + here.name, "", here))
            open_[plain(here.name)].pop()
            here = here.up

    while m := OPENS.search(page, at):
        comment, declared, slash, name = m.groups()
        if comment:
            end = page.find("-->", m.end())
            end = len(page) if end < 0 else end + 3
        else:
            end = tag_end(page, m.end()) if quotes and not declared and m.end() <= last else -1
            if end < 0:
                # from the first tag on that its quotes keep open to the end of the page, quotes mean nothing
                quotes = quotes and (bool(declared) or m.end() > last)
                end = page.find(">", m.end()) if m.end() <= last else -1
            if end < 0 and not declared:  # no tag ends from here on
                text.append(page[at : m.end()])
                at = m.end()
                continue
            end = len(page) if end < 0 else end + 1
        if m.start() > at:
            text.append(page[at : m.start()])
        at = end
        if comment or declared:
            continue
        name = name.lower()
        if name in RAW:
            if not slash and page[end - 2] != "/":
                done = RAW[name].search(page, end)
                at = done.end() if done else len(page)
            continue
        if name not in BLOCKS:
            continue
        flush()
        if name in VOID:
            continue
        if slash:
            if open_.get(name):
                close(open_[name][-1].up)
            continue
        if plain(here.name) == "p" and here.up:
            close(here.up)  # any block ends a paragraph
        if name in ENDS:
            bound = max((open_[b][-1].depth for b in BOUNDS if open_.get(b)), default=0)
            ended = max((open_[e][-1] for e in ENDS[name] if open_.get(e)), key=lambda p: p.depth, default=None)
            if ended is not None and ended.depth > bound:
                close(ended.up)
        here = here.kid(element(name, page[m.end() : end - 1]))
        open_.setdefault(name, []).append(here)
        out.append((here.name, "", here))
    if at < len(page):
        text.append(page[at:])
    while here.up:
        close(here.up)
    flush()
    return out


# A wrapper node is [signature, optional, kind, content]: kind "t" a tag, "#" a text (content [hashes, key of the path, kind,
# marks, doubtful elements]: the texts that every page so far has here), "+" a repeated group (content: nodes).


def fold(nodes: list[list]) -> list[list]:
    """Fold tandem repeats into repeated groups, the shortest first, until none is left."""
    for period in [*range(1, LONGEST + 1)] * 2:
        out, at = [], 0
        signs = [n[0] for n in nodes]
        while at < len(nodes):
            unit, to = signs[at : at + period], at + period
            while signs[to : to + period] == unit:
                to += period
            if to > at + period and (period > 1 or nodes[at][2] != "#"):
                group = nodes[at : at + period]
                for k in range(at + period, to, period):
                    group = [merge(a, b, True) for a, b in zip(group, nodes[k : k + period], strict=True)]
                out.append(group[0] if period == 1 and group[0][2] == "+" else ["(" + " ".join(unit) + ")+", False, "+", group])
                at = to
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
    return nodes


def merge(a: list, b: list, within: bool = False) -> list:
    """One node for two with the same signature, of two pages or ``within`` one."""
    if a[2] == "#":
        x, y = set(a[3][0]), set(b[3][0])
        return [a[0], a[1] or b[1], "#", [sorted(x | y if within else x & y), *a[3][1:]]]
    if a[2] == "+":
        return [a[0], a[1] or b[1], "+", [merge(x, y, within) for x, y in zip(a[3], b[3], strict=True)]]
    return [a[0], a[1] or b[1], "t", None]


def as_groups(nodes: list[list], other: list[list]) -> list[list]:
    """Turn single occurrences of the other stream's repeated groups into repeated groups."""
    for group in {n[0]: n for n in other if n[2] == "+"}.values():
        unit, k = [n[0] for n in group[3]], len(group[3])
        out, at = [], 0
        while at < len(nodes):
            if [n[0] for n in nodes[at : at + k]] == unit:
                out.append([group[0], False, "+", nodes[at : at + k]])
                at += k
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
    return nodes


def align(a: list[list], b: list[list]) -> list[list]:
    """Generalise two streams: common nodes merge, all others become optional."""
    a, b = as_groups(a, b), as_groups(b, a)
    out = []
    for op, i, j, k, m in difflib.SequenceMatcher(None, [n[0] for n in a], [n[0] for n in b], autojunk=False).get_opcodes():
        if op == "equal":
            out += [merge(x, y) for x, y in zip(a[i:j], b[k:m], strict=True)]
        else:
            out += [[n[0], True, *n[2:]] for n in [*a[i:j], *b[k:m]]]
    return out


def skeleton(page: str) -> list[list]:
    """Folded stream of a page; texts are hashes."""
    return folded(read(page))


def folded(stream: list[tuple[str, str, Path]], texts: bool = True) -> list[list]:
    return fold([[t, False, "#", [[xxhash.xxh3_64_hexdigest(s)] if texts else [], p.key, p.kind(), list(p.marks), list(p.maybe)]] if t == "#" else [t, False, "t", None] for t, s, p in stream])


def lists_of(nodes: list[list]) -> set[int]:
    """Doubtful elements that hold a repeated group of items."""
    out: set[int] = set()
    for n in nodes:
        if n[2] == "+":
            out |= lists_of(n[3])
            if of_items(n[3]):
                out |= {k for t in texts_in(n[3]) for k in t[4]}
    return out


def of_items(group: list[list]) -> bool:
    """Does a group start with an item and hold no doubtful element?"""
    return group[0][2] == "t" and plain(group[0][0]) in ITEMS and not any(k[2] == "t" and k[0].endswith("?") for k in group)


def unit_of(group: list[list]) -> int:
    """Number of a group by its tokens."""
    return xxhash.xxh3_64_intdigest(" ".join(n[0] for n in group).encode()) >> 1


def items_of(nodes: list[list]) -> tuple[set[int], set[int], set[tuple[int, int]]]:
    """What a page tells of lists: groups of items that it repeats, doubtful elements that hold a repeated group of items, and
    (group, doubtful element) of what would be one if another page of the host repeats that group."""
    units = {unit_of(n[3]) for n in nodes if n[2] == "+" and of_items(n[3])}
    single: set[tuple[int, int]] = set()
    for at, n in enumerate(nodes):
        if n[2] != "t" or plain(n[0]) not in ITEMS:
            continue
        for to in range(at + 1, min(at + LONGEST, len(nodes)) + 1):
            group = nodes[at:to]
            if not of_items(group):
                break
            if keys := {k for t in texts_in(group) for k in t[4]}:
                unit = unit_of(group)
                single |= {(unit, k) for k in keys}
    return units, lists_of(nodes), single


def texts_in(nodes: list[list]) -> list[list]:
    """Contents of the text nodes."""
    return [t for n in nodes for t in ([n[3]] if n[2] == "#" else texts_in(n[3]) if n[2] == "+" else [])]


def key_of(path: int, text_hash: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{path:x}\0{text_hash}") >> 1


def inside_all(marks: list[tuple[int, ...]]) -> set[int]:
    """Marked elements that all the texts lie inside of."""
    return set.intersection(*map(set, marks)) - {-1} if marks else set()


def conclude(pages: int, texts: list[int], common: list[tuple[int, int, int]], frames: list[tuple[int, int]], slotted: int, main: bool, lists: list[int]) -> dict:
    """Wrapper of a host.

    From its number of different pages, its texts by kind, (key, kind, pages) of common texts, (marked element, pages whose slots
    all lie inside it), the number of pages with slots, whether a page has a main element, and the doubtful elements that are lists.
    """
    fixed = [k for k, _, _ in template(pages, texts, common)]
    frames = [m for m, n in frames if pages >= MANY and n >= NEARLY * slotted]
    return {"many": pages >= MANY, "main": main, "frames": sorted(frames), "lists": sorted(lists), "fixed": sorted(fixed)}


def template(pages: int, texts: list[int], common: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of the common texts that are template."""
    out = []
    for kind in (1, 2, 3):
        same = [c for c in common if c[1] == kind and c[2] >= NEARLY * pages]
        if pages >= MANY and sum(n for *_, n in same) <= ALIKE * texts[kind]:
            out += same
    return out


def align_all(pages: list[list[list]]) -> list[int]:
    """Doubtful elements that are lists in the skeletons of a host, aligned by their repeated groups."""
    told = [items_of(p) for p in pages]
    units = {u for t in told for u in t[0]}
    return sorted({k for t in told for k in t[1]} | {k for t in told for u, k in t[2] if u in units})


def infer(pages: list[list[list]]) -> dict:
    """Wrapper of a host from the skeletons of all its pages."""
    distinct = list({json.dumps(p): p for p in pages}.values())
    told = [{key_of(t[1], h): (t[2], tuple(t[3])) for t in texts_in(p) for h in t[0] if t[2]} for p in distinct]
    counts: dict[tuple[int, int], int] = {}
    for page in told:
        for key, (kind, _) in page.items():
            counts[key, kind] = counts.get((key, kind), 0) + 1
    texts = [sum(kind == k for page in told for kind, _ in page.values()) for k in range(4)]
    common = [(key, kind, n) for (key, kind), n in counts.items()]
    fixed = {k for k, *_ in template(len(distinct), texts, common)}
    slots = [[marks for key, (_, marks) in page.items() if key not in fixed] for page in told]
    frames: dict[int, int] = {}
    for marks in slots:
        for m in inside_all(marks):
            frames[m] = frames.get(m, 0) + 1
    main = any(kind == 2 for page in told for kind, _ in page.values())
    return conclude(len(distinct), texts, common, list(frames.items()), sum(map(bool, slots)), main, align_all(distinct))


NONE = {"many": False, "main": False, "frames": [], "lists": [], "fixed": []}


def extract(page: str, wrapper: dict) -> str:
    """Main text of a page by its host's wrapper."""
    frames, lists, fixed = set(wrapper["frames"]), set(wrapper["lists"]), set(wrapper["fixed"])
    stays: dict[int, int] = {}

    def kind(p: Path) -> int:
        """0: not main text; else as ``Path.kind`` without the marks that are overruled."""
        if p.key not in stays:
            marked = p.hard or any(m not in frames for m in p.marks)
            if p.maybe and not marked:
                marked = any(m in lists for m in p.maybe) if wrapper["many"] else not flat(p)
            stays[p.key] = 0 if marked else 2 if p.main else 1
        return stays[p.key]

    stream = [(s, p, kind(p)) for t, s, p in read(page) if t == "#"]
    # a page without the element that its host's main texts stand in is judged like a host without one
    semantic = any(k == 2 for *_, k in stream) or wrapper["main"] and any(p.main for _, p, _ in stream)
    out: list[str] = []
    waiting: list[tuple[str, Path]] = []  # headings of the template, until it is known what they head
    for said, path, k in stream:
        if k == 0 or k == 1 and semantic:
            continue
        if fixed and key_of(path.key, xxhash.xxh3_64_hexdigest(said)) in fixed:
            if k == 2 and plain(path.name) in HEADINGS:
                waiting.append((said, path.up))
            else:
                waiting.clear()
            continue
        out += [h for h, parent in waiting if path.within(parent)]
        waiting.clear()
        out.append(said)
    return "\n".join(out)


def flat(p: Path) -> bool:
    """On a host of few pages: is the innermost doubtful element a section?"""
    while not p.name.endswith("?"):
        p = p.up
    return plain(p.name) == "section"


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """Wrapper of each host as JSON; ``pages`` has ``host`` and ``html``.

    Every page tells the keys of its texts; they are counted by (host, key) over the different
    pages, with partial sums before the shuffle.  A batch tells the repeated groups of each of its
    token streams once, and the single items are joined with the groups of all pages by (host, group), so
    that little is shuffled and no task gets a host, even if one host has a third of all pages.
    """

    def tell(batches):
        known: dict[int, tuple[list[int], list[int], list[dict]]] = {}  # by form, which says all about groups
        for batch in batches:
            for part in slices(batch, "html"):
                rows: dict[tuple[str, int], tuple] = {}
                forms: set[tuple[str, int]] = set()
                for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    h = xxhash.xxh3_64_intdigest(page.encode()) >> 1
                    if (host, h) in rows:
                        continue
                    stream = read(page)
                    texts = {key_of(p.key, xxhash.xxh3_64_hexdigest(s)): p for t, s, p in stream if t == "#" and not p.hard}
                    form = xxhash.xxh3_64_intdigest(" ".join(t for t, *_ in stream).encode()) >> 1
                    if form not in known:
                        if len(known) >= FORMS:
                            known.clear()
                        units, lists, single = items_of(folded(stream, False))
                        known[form] = sorted(units), sorted(lists), [{"unit": u, "key": k} for u, k in sorted(single)]
                    first = (host, form) not in forms
                    forms.add((host, form))
                    rows[host, h] = [{"key": k, "kind": p.kind(), "marks": list(p.marks)} for k, p in texts.items()], *(known[form] if first else ([], [], []))
                cols = {"host": [k[0] for k in rows], "h": [k[1] for k in rows], **{n: [v[i] for v in rows.values()] for i, n in enumerate(("texts", "units", "lists", "single"))}}
                yield pa.RecordBatch.from_pydict(cols, schema=TOLD)

    told = written(pages.mapInArrow(tell, "host string, h long, texts array<struct<key: long, kind: int, marks: array<long>>>, units array<long>, lists array<long>, single array<struct<unit: long, key: long>>"), "told")
    different = told.select("host", "h", "texts").dropDuplicates(["host", "h"])
    kinds = F.col("texts.kind")
    n_texts = [F.sum(F.size(kinds) - F.size(F.array_remove(kinds, k))).alias(f"t{k}") for k in range(4)]
    hosts = written(different.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"), F.coalesce(F.bool_or(F.array_contains(kinds, 2)), F.lit(False)).alias("main"), *n_texts), "hosts")
    texts = different.select("host", F.explode("texts").alias("x")).groupBy("host", "x.key", "x.kind").agg(F.count(F.lit(1)).alias("n"))
    texts = texts.filter(F.col("n") >= MANY * NEARLY).join(hosts.select("host", "n_pages"), "host").filter(F.col("n") >= NEARLY * F.col("n_pages"))
    # each of them is on nearly all pages, so a host has hardly more of them than a page has texts
    common = texts.groupBy("host").agg(F.collect_list(F.struct("key", "kind", "n")).alias("common"))
    known = hosts.join(common, "host", "left")

    def cut(batches):
        for batch in batches:
            fixed = [sorted(k for k, *_ in template(r["n_pages"], [r[f"t{k}"] for k in range(4)], [(c["key"], c["kind"], c["n"]) for c in r["common"] or []])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fixed, pa.list_(pa.int64()))], names=[*batch.schema.names, "fixed"])

    known = written(known.mapInArrow(cut, T.StructType([*known.schema.fields, T.StructField("fixed", T.ArrayType(T.LongType()))])), "known")
    # marked elements that hold all slots of a page
    slots = F.filter("texts", lambda x: ~F.array_contains("fixed", x["key"]))
    marked = different.join(known.select("host", "fixed"), "host").select("host", F.transform(slots, lambda x: x["marks"]).alias("marks")).filter(F.size("marks") > 0)
    around = marked.select("host", F.explode_outer(F.aggregate("marks", F.get("marks", F.lit(0)), F.array_intersect)).alias("mark"))
    frames = around.groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n"))
    # a page without a frame gives one row without a mark; a page inside several gives a row for each of them
    slotted = marked.groupBy("host").agg(F.count(F.lit(1)).alias("slotted"))
    frames = frames.filter("mark IS NOT NULL AND mark >= 0").join(slotted, "host").filter(F.col("n") >= NEARLY * F.col("slotted"))
    frames = frames.groupBy("host").agg(F.collect_list(F.struct("mark", "n")).alias("frames"), F.first("slotted").alias("slotted"))  # nested in each other: DEPTH at most
    units = told.select("host", F.explode("units").alias("unit")).distinct()
    single = told.select("host", F.inline("single")).distinct().join(units, ["host", "unit"], "left_semi").select("host", "key")
    lists = told.select("host", F.explode("lists").alias("key")).union(single)
    lists = lists.groupBy("host").agg(F.collect_set("key").alias("lists"))  # as many as the host has doubtful elements, by tag path
    joined = known.join(frames, "host", "left").join(lists, "host", "left")

    def finish(batches):
        for batch in batches:
            rows = batch.to_pylist()
            made = [json.dumps(conclude(r["n_pages"], [r[f"t{k}"] for k in range(4)], [(c["key"], c["kind"], c["n"]) for c in r["common"] or []], [(f["mark"], f["n"]) for f in r["frames"] or []], r["slotted"] or 0, r["main"], r["lists"] or [])) for r in rows]
            yield pa.RecordBatch.from_pydict({"host": [r["host"] for r in rows], "wrapper": made}, schema=MADE)

    return joined.mapInArrow(finish, "host string, wrapper string")


TOLD = pa.schema([("host", pa.string()), ("h", pa.int64()), ("texts", pa.list_(pa.struct([("key", pa.int64()), ("kind", pa.int32()), ("marks", pa.list_(pa.int64()))]))), ("units", pa.list_(pa.int64())), ("lists", pa.list_(pa.int64())), ("single", pa.list_(pa.struct([("unit", pa.int64()), ("key", pa.int64())])))])
MADE = pa.schema([("host", pa.string()), ("wrapper", pa.string())])


def extract_text(df: DataFrame, url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """Append the main text of each page."""
    rows = without(df, [text, "__host", "__html", "__wrapper"])
    named = rows.select("*", host_of(F.col(f"`{url}`")).alias("__host"), F.coalesce(F.col(f"`{page}`"), F.lit("")).alias("__html"))
    wrappers = written(infer_wrappers(named.select(F.col("__host").alias("host"), F.col("__html").alias("html"))), "wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host")), F.lit(0))).first()[0]
    wrappers = wrappers.withColumnsRenamed({"host": "__host", "wrapper": "__wrapper"})
    told = named.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "__host", "left").drop("__host")

    def make():
        parsed: dict[str | None, dict] = {None: NONE}

        def f(batch):
            out = []
            for page_, wrapper in zip(batch.column("__html").to_pylist(), batch.column("__wrapper").to_pylist(), strict=True):
                if wrapper not in parsed:
                    if len(parsed) > 1000:
                        del parsed[next(k for k in parsed if k is not None)]
                    parsed[wrapper] = json.loads(wrapper)
                out.append(extract(page_, parsed[wrapper]))
            return [pa.array(out, pa.string())]

        return f

    return add_columns(told, f"`{text}` string", "__html", make).drop("__html", "__wrapper")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
