"""Main text of web pages by union-free regular-expression wrappers, one for each host.

A page becomes a token stream with implied end tags put in, so that every group
of tokens is balanced. Streams of a host are aligned one after another: equal
neighbours fold into repeated groups, what only one side has becomes optional,
texts that differ become slots. Alignment of two wrappers works like that of two
pages, so a host's pages are aligned in groups on many machines and their wrappers
in turn, in an order that a hash of the pages fixes.

The wrapper then says what a page's article is (see ``Rules``): texts that every
page has are the frame; the region that holds the slots' prose is the article; what
holds links rather than prose is left out. Roles that tags and class words name
come before that evidence, but a region so named counts only if its texts vary.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: A wrapper table of at most so many bytes is sent to all tasks; a larger one is joined by host.
BROADCAST_BYTES = 32 << 20
#: Pages of a host that one task aligns, and wrappers that it merges then.
GROUP, WIDTH = 512, 64
#: The share of a region's prose from which the article is sought in one of its parts.
MOST = 0.6
#: Elements nested deeper are taken as children of the last level.
DEEPEST = 120

# Fixed values of the HTML standard: void elements, elements whose text is not markup, block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
BLOCK = frozenset("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: A new element of this kind ends an open one of those kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An open element of these kinds is not ended from within a nested one.
SCOPE = frozenset("html body article section main div ul ol dl table td th blockquote nav header footer aside form".split())
MAIN = frozenset(["article", "main"])
DROP = frozenset("nav aside footer form script style noscript iframe template svg button select textarea input dialog head title menu object canvas".split())
#: Words of class, id or role that mark what is not the article.
DROP_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo banner sidebar side cookie cookies consent notice notices alert popup modal newsletter subscribe share sharing social related recommended comment comments respond reply replies disqus nav navbar navigation menu breadcrumb breadcrumbs footer header masthead pagination pager widget hidden legal copyright".split())
#: Words that go with those above in hyphenated names and say nothing themselves.
FILLER = frozenset("list box bar area wrap wrapper container inner outer block links link item items section panel slot site page top bottom left right post form unit zone holder group row column col head body title text".split())
#: Elements within which an article without a name is sought.
CONTAINERS = frozenset("html body div section table tbody tr td center main article form fieldset".split())
HEADINGS = frozenset(["h1", "h2"])
MAIN_WORDS = frozenset("article content main post entry story body-text articlebody entry-content post-content main-content".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?>"[^"]*"|'[^']*'|[^'">])*+)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = " "


def tokens(page: str) -> Iterator[tuple]:
    """``("<", tag, words)``, ``(">", tag)`` and ``("#", text)``; comments and the text of scripts and styles are left out."""
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            yield "#", page[at:]
            return
        if m.start() > at:
            yield "#", page[at : m.start()]
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            yield ">", tag
            continue
        words = frozenset()
        if m[3] and not m[3].isspace():
            found = [(k.lower(), v.strip("\"'").lower()) for k, v in _ATTR.findall(m[3])]
            words = frozenset(w for k, v in found for w in (v.split() if "hidden" not in k else ["hidden"] if v not in ("false",) else []))
        yield "<", tag, words
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else n
        elif m[3].endswith("/") and tag not in VOID:
            pass  # a slash means nothing in HTML


def tells_drop(word: str) -> bool:
    """Does a class word name a part to leave out? A hyphenated one does if it has such a word and at least half of it are such or fillers."""
    if word in DROP_WORDS:
        return True
    parts = [p for p in re.split(r"[-_]", word) if p]
    return len(parts) > 1 and not DROP_WORDS.isdisjoint(parts) and 2 * sum(p in DROP_WORDS or p in FILLER for p in parts) > len(parts)


def label(tag: str, words: frozenset) -> str:
    """The name of an element in a wrapper: its tag, and the words of its class, id and role that are made of letters."""
    return ".".join([tag, *sorted(w for w in words if w.replace("-", "").replace("_", "").isalpha())])


def parse(page: str) -> list:
    """The page as a tree ``[label, children]``; a text is ``["#", text]``. Missing end tags are put in."""
    root: list = ["", []]
    stack, tags = [root], [""]
    is_open: Counter = Counter()

    def close(i: int) -> None:
        is_open.subtract(tags[i:])
        del stack[i:], tags[i:]

    for t in tokens(page):
        if t[0] == "#":
            stack[-1][1].append(["#", t[1]])
            continue
        tag = t[1]
        if t[0] == ">":
            for i in range(len(tags) - 1, 0, -1) if is_open[tag] else ():
                if tags[i] == tag:
                    close(i)
                    break
                if tags[i] in SCOPE and tag not in SCOPE:
                    break
            continue
        ends = CLOSES.get(tag, {"p"} if tag in BLOCK else set())
        for i in range(len(tags) - 1, 0, -1) if any(is_open[e] for e in ends) else ():
            if tags[i] in ends:
                close(i)
                break
            if tags[i] in SCOPE:
                break
        node: list = [label(tag, t[2]), []]
        stack[-1][1].append(node)
        if tag not in VOID:
            # a deeper element is open too, so that its end tag is its own, but what it holds goes to the last level
            stack.append(node if len(stack) < DEEPEST else stack[-1])
            tags.append(tag)
            is_open[tag] += 1
    return root


# ---- wrappers: [label, items]; item: [node, optional, repeated]; a text node: ["#", digests, most characters, varies].
# A page's own node has the digests of all texts that fold into it; that of several pages those that every page has.


def skeleton(node: list) -> list:
    """A parsed element as a wrapper of its own: texts by digest, neighbours that repeat folded."""
    items = []
    for child in node[1]:
        if child[0] == "#":
            text = _SPACE.join(child[1].split())
            if text:
                items.append([["#", [hashlib.md5(text.encode()).hexdigest()[:12]], len(text), False], False, False])
        else:
            items.append([skeleton(child), False, False])
    return [node[0], fold_repeats(items)]


def fold_repeats(items: list) -> list:
    """Fold runs of neighbours with equal labels, of periods one to three, into repeated groups."""
    for period in (1, 2, 3):
        out: list = []
        i = 0
        while i < len(items):
            keys = [x[0][0] for x in items[i : i + period]]
            j = i + period
            while period > 0 and len(keys) == period and len(set(keys)) == period and [x[0][0] for x in items[j : j + period]] == keys:
                j += period
            if j > i + period:
                group = items[i : i + period]
                for at in range(i + period, j, period):
                    group = [merge_items(a, b, True) for a, b in zip(group, items[at : at + period], strict=True)]
                if period == 1:
                    out.append([group[0][0], group[0][1], True])
                else:
                    out.append([["()" + " ".join(keys), group], False, True])
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def merge_items(a: list, b: list, fold: bool = False) -> list:
    return [merge(a[0], b[0], fold), a[1] or b[1], a[2] or b[2]]


def merge(a: list, b: list, fold: bool = False) -> list:
    """The wrapper that covers two wrappers with one label, of different pages or (``fold``) of one."""
    if a[1:] == b[1:]:
        return a
    if a[0] == "#":
        x, y = set(a[1]), set(b[1])
        return ["#", sorted(x | y if fold else x & y), max(a[2], b[2]), a[3] or b[3] or not fold and x != y]
    return [a[0], align(a[1], b[1], fold)]


def common(ka: list, kb: list) -> list[tuple[int, int]]:
    """A longest common subsequence as pairs of places; of several the one that moves on in ``ka`` first.

    Lengths are worked out row by row from the end; every so many rows one is
    kept, and those between are worked out again on the way back, so memory grows
    with the length to the power of one and a half only.
    """
    n, m = len(ka), len(kb)
    if n * m <= 4096:  # the same by a plain table, which is faster for short ones
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(m - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
        return _back(ka, kb, lambda i: best[i])
    number: dict = {}
    xa = [number.setdefault(k, len(number)) for k in ka]
    xb = np.array([number.setdefault(k, len(number)) for k in kb], np.int64)

    def above(i: int, below: np.ndarray) -> np.ndarray:
        row = np.zeros(m + 1, np.int32)
        row[:-1] = np.maximum(below[:-1], np.where(xb == xa[i], below[1:] + 1, 0))
        return np.maximum.accumulate(row[::-1])[::-1]

    step = max(1, int(n**0.5))
    kept = {n: np.zeros(m + 1, np.int32)}
    row = kept[n]
    for i in range(n - 1, -1, -1):
        row = above(i, row)
        if i % step == 0:
            kept[i] = row
    rows: dict[int, np.ndarray] = {}

    def at(i: int) -> np.ndarray:
        if i not in rows:
            end = min(n, (-(-i // step)) * step)
            rows.clear()
            rows[end] = kept[end]
            for k in range(end - 1, max(i - step, 0) - 1, -1):
                rows[k] = above(k, rows[k + 1])
        return rows[i]

    return _back(ka, kb, at)


def _back(ka: list, kb: list, row) -> list[tuple[int, int]]:
    """The pairs on the way from the start, by the lengths ``row(i)`` from each place of ``ka``."""
    pairs, i, j = [], 0, 0
    while i < len(ka) and j < len(kb):
        if ka[i] == kb[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif row(i + 1)[j] >= row(i)[j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def align(a: list, b: list, fold: bool = False) -> list:
    """Align two sequences of items by their labels: common ones merge, the others become optional."""
    ka, kb = [x[0][0] for x in a], [x[0][0] for x in b]
    if ka == kb:
        return [merge_items(x, y, fold) for x, y in zip(a, b, strict=True)]
    pairs = common(ka, kb)
    out: list = []
    i = j = 0
    for x, y in [*pairs, (len(a), len(b))]:
        for extra in [*a[i:x], *b[j:y]]:
            # an optional neighbour with the same label as one just put in is a repetition of it
            if out and out[-1][0][0] == extra[0][0] and out[-1][1]:
                out[-1] = [merge(out[-1][0], extra[0], True), True, True]
            else:
                out.append([extra[0], True, extra[2]])
        if x < len(a):
            out.append(merge_items(a[x], b[y], fold))
        i, j = x + 1, y + 1
    return out


def as_regex(wrapper: list) -> str:
    """The wrapper as a readable union-free regular expression."""
    if wrapper[0] == "#":
        return "#text" if wrapper[3] else "#same"
    body = " ".join(as_regex(n) + ("*" if o and r else "+" if r else "?" if o else "") for n, o, r in wrapper[1])
    if wrapper[0].startswith("()"):
        return f"({body})"
    return f"<{wrapper[0]}>{body}</{wrapper[0].split('.')[0]}>" if wrapper[0] else body


def _is_drop(name: str) -> bool:
    tag, *words = name.split(".")
    return tag in DROP or any(map(tells_drop, words)) and tag not in ("body", "html", "article", "main")


def _is_main(name: str) -> bool:
    tag, *words = name.split(".")
    return not _is_drop(name) and (tag in MAIN or any(w in MAIN_WORDS for w in words) and tag in ("div", "section", "td"))


class Rules:
    """What a host's wrapper says of each path of labels.

    ``main``: the article's regions; ``same``: texts that every page has, by path;
    ``lists``: parts that hold links rather than prose. Prose counts only where it
    varies (on a host's only page all does). Regions that tags or words name are
    taken if any of their prose varies, those without such prose then not. Else
    (``found``) the region is sought from the top: the part that holds most of
    what varies, and on within it, until the prose is spread over several parts or
    a heading that varies stands beside them.
    """

    def __init__(self, wrapper: list, pages: int) -> None:
        self.same: set[tuple] = set()
        self.prose: dict[tuple, int] = {}
        self.links: dict[tuple, int] = {}
        self.parts: dict[tuple, dict[tuple, None]] = {}
        named: dict[tuple, None] = {}
        self._walk(wrapper, (), pages > 1, False, named)
        self.main = {p for p in named if self.prose[p]} or set(named)
        self.found = not any(self.prose[p] for p in named) and pages > 1
        if self.found and (region := self._seek()):
            self.main = {region}
        else:
            self.found = False
        self.lists = {p for p, n in self.links.items() if n > self.prose[p]} if self.found else set()

    def _walk(self, node: list, path: tuple, everywhere: bool, link: bool, named: dict) -> tuple[int, int]:
        prose = links = 0
        for child, optional, _ in node[1]:
            name, on_all = child[0], everywhere and not optional
            if name == "#":
                self.same.update((path, digest) for digest in child[1] if on_all)
                if on_all and not child[3]:
                    continue
                if link:
                    links += child[2]
                else:
                    prose += child[2]
            elif name.startswith("()"):
                p, n = self._walk(child, path, on_all, link, named)
                prose, links = prose + p, links + n
            elif not _is_drop(name):
                below = (*path, name)
                if _is_main(name):
                    named[below] = None
                self.parts.setdefault(path, {})[below] = None
                p, n = self._walk(child, below, on_all, link or name.split(".")[0] == "a", named)
                self.prose[below] = self.prose.get(below, 0) + p
                self.links[below] = self.links.get(below, 0) + n
                prose, links = prose + p, links + n
        return prose, links

    def _seek(self) -> tuple:
        path: tuple = ()
        while parts := self.parts.get(path):
            total = sum(self.prose[p] for p in parts)
            best = max(parts, key=lambda p: self.prose[p])
            tag = best[-1].split(".")[0]
            if not total or self.prose[best] < MOST * total or tag not in CONTAINERS or any(p[-1].split(".")[0] in HEADINGS and self.prose[p] for p in parts):
                break
            path = best
        return path


def main_text(page: str | None, rules: Rules | None) -> str:
    """The article's blocks in page order, one a line.

    Where the wrapper has an article region and the page fills it, its text
    counts, in a region found without a name less what is the same on every page
    of the host and parts that hold links; else all that is neither a part to leave
    out nor the same on every page; and such texts too if nothing else is left.
    """
    if not page:
        return ""
    tree = parse(page)
    frame = rules.same if rules else set()
    for inside, same in ((True, frame if rules and rules.found else set()), (False, frame), (False, set())):
        blocks: list[str] = []
        line: list[str] = []
        lists = rules.lists if rules and inside else ()

        def flush(blocks=blocks, line=line) -> None:
            text = _SPACE.join(html_lib.unescape("".join(line)).split())
            line.clear()
            if text:
                blocks.append(text)

        def walk(node: list, path: tuple, active: bool, line=line, inside=inside, same=same, lists=lists, flush=flush) -> None:
            for child in node[1]:
                name = child[0]
                if name == "#":
                    if active and not (same and (path, hashlib.md5(_SPACE.join(child[1].split()).encode()).hexdigest()[:12]) in same):
                        line.append(child[1])
                    continue
                tag = name.split(".", 1)[0]
                if tag == "br":
                    if active:
                        line.append(" ")
                    continue
                below = (*path, name)
                drop = _is_drop(name) or tag == "header" and not inside or tag in BLOCK and below in lists
                on = not drop and (active or (inside and rules is not None and below in rules.main))
                block = tag in BLOCK
                if active and block:
                    flush()
                if not drop:
                    walk(child, below, on)
                if (active or on) and block:
                    flush()

        walk(tree, (), not inside)
        flush()
        if blocks or not inside and not same:
            return "\n".join(blocks)
    return ""


def _host() -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col("url__"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def merged(rows: list[tuple[int, str, int]]) -> tuple[str, int]:
    """The wrapper of ``(hash, wrapper, pages)`` rows, merged in the order of hashes and wrappers, and its pages."""
    rows = sorted(rows)
    wrapper, last = json.loads(rows[0][1]), rows[0][1]
    for _, text, _ in rows[1:]:
        if text != last:
            wrapper, last = merge(wrapper, json.loads(text)), text
    return json.dumps(wrapper), sum(n for _, _, n in rows)


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, n)`` of ``pages(host, html)``.

    Each page becomes a wrapper of its own; a hash of its html deals a host's pages
    to groups of about ``GROUP``, and their wrappers meet by ``WIDTH`` and ``WIDTH``, so no
    task sees more of a host than that, and no result depends on how rows are dealt.
    """
    kind = "host string, at long, h long, wrapper string, n long"
    counts = materialize(pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "html-hosts")
    few = counts.count() <= 200_000
    most = counts.agg(F.max("pages")).first()[0] or 0

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [json.dumps(skeleton(parse(p.as_py()))) for p in batch.column(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(own, pa.string()), pa.array([1] * len(own), pa.int64())], ["host", "at", "h", "wrapper", "n"])

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        wrapper, n = merged(list(zip(*(table.column(c).to_pylist() for c in ("h", "wrapper", "n")), strict=True)))
        return pa.table({"host": [key[0].as_py()], "at": pa.array([key[1].as_py()], pa.int64()), "h": pa.array([key[1].as_py()], pa.int64()), "wrapper": [wrapper], "n": pa.array([n], pa.int64())})

    dealt = pages.join(F.broadcast(counts) if few else counts, "host").withColumn("h", F.xxhash64("html__"))
    rows = dealt.select("host", F.pmod("h", F.ceil(F.col("pages") / GROUP)).alias("at"), "h", "html__").mapInArrow(first, kind)
    rows = rows.groupBy("host", "at").applyInArrow(meet, kind)
    width = -(-most // GROUP)
    while width > 1:
        width = -(-width // WIDTH)
        rows = rows.withColumn("at", F.floor(F.col("at") / WIDTH)).groupBy("host", "at").applyInArrow(meet, kind)
    return rows.select("host", "wrapper", "n")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of every page.

    A null or empty html gives an empty text; pages without a readable host
    share one wrapper; markup that is never closed ends with the page. Repeated
    rows give equal rows; other columns are ignored.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id__"), F.col(url_col).alias("url__"), F.col(html_col).alias("html__")).withColumn("host", _host())
    learned = materialize(wrappers(rows.filter("html__ is not null").select("host", "html__")), "wrappers")
    size = learned.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host") + 16), F.lit(0))).first()[0]
    joined = rows.join(F.broadcast(learned) if size <= BROADCAST_BYTES else learned, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: dict[str, Rules] = {}
        for batch in batches:
            ids, urls, pages_, hosts, ws, ns = (batch.column(i) for i in range(6))
            texts = []
            for page, host, w, n in zip(pages_, hosts.to_pylist(), ws, ns.to_pylist(), strict=True):
                if n is not None and host not in rules:
                    if len(rules) > 4096:
                        rules.clear()
                    rules[host] = Rules(json.loads(w.as_py()), n)
                texts.append(main_text(page.as_py(), rules[host] if n is not None else None))
            yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [id_col, url_col, "text", "n_chars"])

    return joined.select("id__", "url__", "html__", "host", "wrapper", "n").mapInArrow(run, f"`{id_col}` {id_type}, `{url_col}` string, text string, n_chars long")
