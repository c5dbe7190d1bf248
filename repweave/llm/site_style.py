"""HTML main text extraction (operator 11) by site style trees.

The DOMs of a host are merged into one style tree, as a table: an element node is the path of tags and
classes that leads to it; its styles are the sequences of children it has on pages, its contents the text
blocks that stand in it. Grouped counts give entropies:

* content: 1 - log k / log m for a text block that k of the site's m pages hold at that node;
* presentation: the entropy of a node's styles over its pages, relative to the greatest possible;

both drawn towards 1 on few pages. Pages are counted by their longest text block, so copies of an article, edited
ones too, are one page and never make its text look like a template (where a passage that many pages cite is their
longest block they count as one page as well, and less of a template is seen). On each page the importance of a branch is
composed, bottom up, from its own presentation and its children (weighted by their text), and branches of
low importance are removed. Elements that name themselves (nav, footer, class="ad", role="dialog", ...)
go in any case, and where a page marks its article, the text is inside it; there a branch goes only if
nearly all pages of the site have it.

Only hashes are shuffled, never html. What the tasks look up is the part of the tables with low importance: a
block counts only if at least m**(1 - KEEP_BELOW) pages hold it, so a site with m pages of b blocks has at most
b * m**KEEP_BELOW such entries. They are written to the shared folder in buckets of hosts of bounded expected
size; a worker holds few of them, and if there are more, pages are dealt by bucket and sorted first.

Defined cases: NULL or empty html gives an empty text; a NULL url, or one without host, is a page without a site and
is judged by its own elements; unclosed or crossing tags end where their parent does; an unfinished tag at the
end is no text; a reference that names no character stays as written; white space is what Unicode calls so;
repeated rows are each extracted; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import io
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from repweave.llm.common import batch, bounded_batches, materialise, read_file, shared_path, write_file
from repweave.llm.url_filter import host_and_path

#: Branches below this importance go; within a marked article only those below the second.
KEEP_BELOW, ARTICLE_BELOW = 0.3, 0.08
#: Weight of the children falls with the number of styles: a node of many styles speaks for itself.
GAMMA = 0.9
#: Pages at which an entropy counts for (m - 1) / (m - 1 + FEW).
FEW = 1.5
#: Entries of one bucket of the shared table, 13 bytes each, and how many buckets a worker holds.
BUCKET_ENTRIES = 500_000
HELD_BUCKETS = 4
#: Tasks that the pages of one bucket are dealt to when there are more buckets than a worker holds.
SPREAD = 64

# FIXED VALUES: HTML element names by what they mean for blocks, and words that name page furniture.
VOID = frozenset("area base col embed hr img input link meta param source track wbr br".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
FORMATTING = frozenset("abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark nobr q ruby rb rt s samp small strike "
                       "strong sub sup tt u var wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript "
                  "ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr "
                  "ul video audio canvas object button".split())
FURNITURE = frozenset("aside audio button canvas dialog dir fieldset footer form head header menu nav noscript object "
                      "optgroup option search select svg template video".split())
FURNITURE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
                            "status toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs captcha comment "
    "comments commentlist consent cookie cookies copyright disclaimer disqus dropdown footer gdpr header hidden login "
    "masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall "
    "popup promo promoted promotion recommendations recommended related replies reply respond share sharing sidebar sidenav "
    "signup skyscraper social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split())
#: Opening one of these ends an open element of the second set, up to the third.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
        "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
PARAGRAPH_SCOPE = frozenset({"td", "th", "table", "caption", "button", "object", "template", "html"})

_TAG = re.compile(r"""<(?:!--(?:.*?--!?>|.*\Z)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(>|\Z)"""
                  r"""|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>|\Z)|/[^>]*+(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

HARD, SOFT = 2, 1


def describe(tag: str, attributes: str) -> tuple[str, int, bool]:
    """(name in the style tree, whether it names itself furniture, whether it marks the article)."""
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    role = found.get("role", "").strip().lower()
    marks = tag in ("article", "main") or role in ("main", "article") or "articlebody" in found.get("itemprop", "").lower()
    named = f"{found.get('class', '')} {found.get('id', '')}"
    # words between signs, and those that capitals join
    words = {*re.findall("[a-z]+", named.lower()), *(w.lower() for w in _WORD.findall(named))}
    furniture = 0
    if tag not in ("html", "body"):
        if any(w in FURNITURE_WORDS for w in words):
            furniture = SOFT
        if ("hidden" in found or found.get("aria-hidden") == "true" or _INVISIBLE.search(found.get("style", ""))
                or role in FURNITURE_ROLES or tag in FURNITURE):
            furniture = HARD
    # numbers in classes and ids are of the page, not of its template
    return f"{tag} {re.sub(r'[0-9]+', '', named)}".rstrip(), furniture, marks


_DESCRIBED: dict[tuple[str, str], tuple[str, int, bool]] = {}


def described(tag: str, attributes: str) -> tuple[str, int, bool]:
    if not attributes or tag == "a" and not any(x in attributes for x in ("class", "id=", "role", "hidden", "style")):
        attributes = ""
    key = tag, attributes
    if key not in _DESCRIBED:
        if len(_DESCRIBED) > 50_000:
            _DESCRIBED.clear()
        _DESCRIBED[key] = describe(tag, attributes)
    return _DESCRIBED[key]


class Page:
    """The block elements of a page in page order (``parent``, ``tag``, ``name``, ``furniture``, ``marks``) and its
    text blocks, ``blocks``, as (element, text)."""

    def __init__(self, source: str):
        self.parent, self.tag, self.name = [0], [""], [""]
        self.furniture, self.marks = [0], [False]
        self.blocks: list[tuple[int, str]] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        # open elements: (tag, element number; inline ones have -1, or -2 if their text is furniture)
        stack: list[tuple[str, int]] = [("", 0)]
        open_tags: Counter[str] = Counter()
        pieces: list[str] = []
        dropped = 0

        def flush() -> None:
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    at = next(n for _, n in reversed(stack) if n >= 0)
                    self.blocks.append((at, text))
                pieces.clear()

        def close(upto: int) -> None:
            nonlocal dropped
            while len(stack) > upto:
                tag, n = stack.pop()
                open_tags[tag] -= 1
                dropped -= n == -2

        def end_open(tags: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
            while any(open_tags[t] > 0 for t in tags):
                i = len(stack) - 1
                while i and stack[i][0] not in tags and stack[i][0] not in scope:
                    i -= 1
                if not i or stack[i][0] in scope:
                    break
                close(i)

        def text(piece: str) -> None:
            if piece and not dropped:
                pieces.append(html.unescape(piece) if "&" in piece else piece)

        at = 0
        while True:
            m = _TAG.search(source, at)
            if not m:
                text(source[at:])
                break
            text(source[at:m.start()])
            at = m.end()
            tag = m[2] or m[6]
            if not tag or not (m[4] or m[8]):
                # a comment, a declaration, or a tag that the text ends in
                continue
            tag = tag.lower()
            ending, attributes = bool(m[1] or m[5]), (m[3] or m[7] or "")
            if ending:
                if tag == "br":
                    pieces.append(" ")
                elif tag in BLOCK:
                    flush()
                    if open_tags[tag] > 0:
                        i = len(stack) - 1
                        while stack[i][0] != tag:
                            i -= 1
                        close(i)
                elif tag not in FORMATTING and open_tags[tag] > 0:
                    i = len(stack) - 1
                    while stack[i][1] < 0 and stack[i][0] != tag:
                        i -= 1
                    if stack[i][0] == tag:
                        close(i)
                continue
            if tag in FORMATTING:
                continue
            if tag in VOID:
                if tag == "br":
                    pieces.append(" ")
                elif tag == "hr":
                    flush()
                    end_open({"p"}, PARAGRAPH_SCOPE)
                continue
            if tag in RAW:
                end = _RAW_END[tag].search(source, at)
                at = end.start() if end else len(source)
                continue
            name, furniture, marks = described(tag, attributes)
            if tag in BLOCK or marks:
                flush()
                end_open({"p"}, PARAGRAPH_SCOPE)
                if tag in ENDS:
                    end_open(*ENDS[tag])
                self.parent.append(next(n for _, n in reversed(stack) if n >= 0))
                self.tag.append(tag)
                self.name.append(name)
                self.furniture.append(furniture)
                self.marks.append(marks)
                stack.append((tag, len(self.tag) - 1))
            else:
                stack.append((tag, -2 if furniture else -1))
                dropped += furniture > 0
            open_tags[tag] += 1
        flush()

    def keys(self, host: int) -> tuple[list[int], list[int], list[int]]:
        """(path of each element, style of each element, content of each text block), hashed with the host."""
        path = [xxh64_intdigest(b"", host)]
        children: list[list[str]] = [[] for _ in self.tag]
        for p, name in zip(self.parent[1:], self.name[1:]):
            path.append(xxh64_intdigest(name, path[p]))
            if not children[p] or children[p][-1] != name:
                children[p].append(name)
        content = []
        for n, text in self.blocks:
            if "#" not in children[n]:
                children[n].append("#")
            content.append(xxh64_intdigest(text, path[n]))
        style = [xxh64_intdigest("\0".join(c), p) for c, p in zip(children, path)]
        return path, style, content

    def main_text(self, importance: dict[int, tuple[float, float]] | None = None, path: list[int] | None = None,
                  content: list[int] | None = None) -> str:
        """The text blocks that stay, two line ends apart. ``importance`` holds what is low: (importance, styles) by
        path of elements and by content of blocks."""
        n = len(self.tag)
        # what stands in furniture, and in an article that no furniture holds
        def under(level: list[int]) -> list[bool]:
            out = [False] * n
            for i in range(1, n):
                out[i] = out[self.parent[i]] or level[i] > 0
            return out

        level = list(self.furniture)
        within = under([int(m) for m in self.marks])
        for i in range(1, n):
            # a header of an article holds its title
            if self.tag[i] == "header" and level[i] == HARD and within[i]:
                level[i] = 0
            # a form around the title or the article is the page, and what holds an article's title is no furniture
            if self.marks[i] or self.tag[i] == "h1":
                j = i
                while j:
                    if self.tag[j] == "form" or self.tag[i] == "h1" and within[j] and level[j] == SOFT:
                        level[j] = 0
                    j = self.parent[j]
        gone = under(level)
        articles = [i for i in range(1, n) if self.marks[i] and not gone[i]]
        if not articles and any(self.marks):
            # no article is free of furniture: names alone do not count around and on the marked ones
            for i in range(1, n):
                if self.marks[i]:
                    j = i
                    while j:
                        level[j] = 0 if level[j] == SOFT else level[j]
                        j = self.parent[j]
            gone = under(level)
            articles = [i for i in range(1, n) if self.marks[i] and not gone[i]]
        marked = set(articles)
        inside = under([int(i in marked) for i in range(n)])
        holds = [False] * n
        for i in articles:
            j = i
            while j and not holds[j]:
                holds[j] = True
                j = self.parent[j]
        stays = [not gone[e] and (inside[e] or not articles) for e, _ in self.blocks]
        if importance and path is not None and content is not None:
            low = self._low(importance, path, content, inside, holds)
            stays = [s and not x for s, x in zip(stays, low)]
        return "\n\n".join(t for (_, t), s in zip(self.blocks, stays) if s)

    def _low(self, importance: dict[int, tuple[float, float]], path: list[int], content: list[int], inside: list[bool],
             holds: list[bool]) -> list[bool]:
        """Whether each text block stands in a branch of low importance, or is one."""
        n = len(self.tag)
        weight, value = [0.0] * n, [0.0] * n
        blocks = []
        for (e, text), key in zip(self.blocks, content):
            own = importance.get(key, (1.0, 0.0))[0]
            blocks.append(own)
            weight[e] += len(text)
            value[e] += own * len(text)
        whole = [1.0] * n
        for i in range(n - 1, 0, -1):
            inner = value[i] / weight[i] if weight[i] else 1.0
            own, styles = importance.get(path[i], (1.0, math.inf))
            share = GAMMA ** styles
            whole[i] = (1 - share) * own + share * inner
            p = self.parent[i]
            weight[p] += weight[i]
            value[p] += whole[i] * weight[i]
        cut = [ARTICLE_BELOW if x else KEEP_BELOW for x in inside]
        low = [False] * n
        for i in range(1, n):
            kept = holds[i] or self.marks[i] or self.tag[i] in ("html", "body")
            low[i] = low[self.parent[i]] or (not kept and whole[i] < cut[i])
        return [low[e] or own < cut[e] for (e, _), own in zip(self.blocks, blocks)]

    def signature(self) -> int:
        """What makes this page a page of its own: its longest text block."""
        return xxh64_intdigest(max((t for _, t in self.blocks), key=lambda t: (len(t), t), default=""))


NODES = "host long, element long, value long, page long"
NODES_ARROW = pa.schema([(c, pa.int64()) for c in ("host", "element", "value", "page")])


def site(url: Column) -> Column:
    """The hash of a url's host, NULL without one."""
    host, _ = host_and_path(url.cast("string"))
    return F.when(host != "", F.xxhash64(host))


def signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def nodes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, element, value, page) of each page: its styles by element, its contents under element 0, and the page
    itself under value 0; each once a page."""
    rows = pages.select(site(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).where("host is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            hosts, elements, values, marks = [], [], [], []
            for host, source in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                page = Page(source or "")
                path, style, content = page.keys(host & (1 << 64) - 1)
                found = {(0, 0), *zip(path[1:], style[1:]), *((0, c) for c in content)}
                mark = page.signature()
                for element, value in found:
                    hosts.append(host)
                    elements.append(element)
                    values.append(value)
                    marks.append(mark)
            yield batch(NODES_ARROW, [pa.array(hosts, pa.int64()), *[pa.array(signed(c)) for c in (elements, values, marks)]])

    return rows.mapInArrow(run, NODES)


def low_importance(pages: DataFrame, url_col: str = "url", html_col: str = "html", below: float = KEEP_BELOW) -> DataFrame:
    """(host, key, importance, styles): the elements and contents of all sites' style trees with low importance."""
    counts = (nodes(pages, url_col, html_col).distinct().groupBy("host", "element", "value").agg(F.count(F.lit(1)).alias("k"))
              .where("k > 1 or element <> 0 or value = 0"))
    counts = materialise(counts, "style-tree")
    hosts = counts.where("element = 0 and value = 0 and k > 1").select("host", F.col("k").alias("m"))
    trust = lambda m: (m - 1) / (m - 1 + FEW)
    contents = counts.where("element = 0 and value <> 0").select("host", F.col("value").alias("key"), "k", F.lit(0.0).alias("styles"))
    share = F.col("k") / F.col("n")
    elements = (counts.where("element <> 0").groupBy("host", "element")
                .agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.ln("k")).alias("s"), F.count(F.lit(1)).alias("styles"))
                .where("n > 1"))
    # entropy of the styles, -sum k/n ln k/n, relative to ln n
    spread = (F.ln("n") - F.col("s") / F.col("n")) / F.ln("n")
    elements = elements.select("host", F.col("element").alias("key"), F.col("n").alias("k"), spread.alias("spread"),
                               F.col("styles").cast("double").alias("styles"))
    reach = F.ln(F.col("k")) / F.ln(F.col("m"))
    contents = contents.join(hosts, "host").select("host", "key", (1 - trust(F.col("m")) * F.least(reach, F.lit(1.0))).alias("importance"),
                                                   "styles")
    elements = elements.join(hosts, "host").where(reach >= 1 - below).select(
        "host", "key", (1 - trust(F.col("k")) * (1 - F.col("spread"))).alias("importance"), "styles")
    return contents.unionByName(elements).where(F.col("importance") < below)


def write_buckets(low: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> tuple[str, int, frozenset[int]]:
    """Write the entries in buckets of hosts; returns folder, number of buckets, and those that have a file."""
    spark = low.sparkSession
    folder = shared_path(spark, "style")
    low = materialise(low, "style-low")
    buckets = max(1, -(-low.count() // bucket_entries))

    def write(key: tuple, part: pa.Table) -> pa.Table:
        number = key[0].as_py()
        part = part.sort_by("key")
        out = io.BytesIO()
        np.savez(out, key=part.column("key").to_numpy(), importance=part.column("importance").to_numpy().astype(np.float32),
                 styles=np.minimum(part.column("styles").to_numpy(), 255).astype(np.uint8))
        write_file(f"{folder}/bucket-{number}.npz", out.getvalue())
        return pa.table({"bucket": pa.array([number], pa.int32())})

    dealt = low.withColumn("bucket", F.pmod("host", F.lit(buckets)).cast("int"))
    written = dealt.groupBy("bucket").applyInArrow(write, "bucket int").distinct().collect()
    return folder, buckets, frozenset(r["bucket"] for r in written)


_BUCKETS: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def load_bucket(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if path not in _BUCKETS:
        while len(_BUCKETS) >= HELD_BUCKETS:
            del _BUCKETS[next(iter(_BUCKETS))]
        with np.load(io.BytesIO(read_file(path))) as z:
            _BUCKETS[path] = z["key"], z["importance"], z["styles"]
    return _BUCKETS[path]


def look_up(table: tuple[np.ndarray, np.ndarray, np.ndarray], keys: list[int]) -> dict[int, tuple[float, float]]:
    known, importance, styles = table
    wanted = signed(keys)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return {keys[i]: (float(importance[at[i]]), float(styles[at[i]])) for i in np.flatnonzero(known[at] == wanted).tolist()}


EXTRACTED = "page_id long, url string, text string, n_chars long"
EXTRACTED_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """The main text of each page."""
    bounded_batches(pages.sparkSession)
    folder, buckets, written = write_buckets(low_importance(pages, url_col, html_col), bucket_entries)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), site(F.col(url_col)).alias("host"))
    rows = rows.withColumn("bucket", F.pmod("host", F.lit(buckets)).cast("int"))
    if buckets > HELD_BUCKETS:
        rows = rows.repartition("bucket", F.pmod(F.xxhash64("id", "url", "html"), F.lit(SPREAD))).sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            out = []
            for source, host, bucket in zip(*[rb.column(i).to_pylist() for i in (2, 3, 4)]):
                page = Page(source or "")
                if bucket in written and page.blocks:
                    path, _, content = page.keys(host & (1 << 64) - 1)
                    low = look_up(load_bucket(f"{folder}/bucket-{bucket}.npz"), path + content)
                    out.append(page.main_text(low, path, content))
                else:
                    out.append(page.main_text())
            yield batch(EXTRACTED_ARROW, [rb.column(0), rb.column(1), out, [len(t) for t in out]])

    return rows.mapInArrow(run, EXTRACTED)
