"""Main text of web pages by nearest-URL page differencing.

Pages are put in the order of host and URL path and cut into blocks of equal
numbers of pages, each with the pages beyond its edges, so that a large host is spread
over many tasks and the cuts change no row.  A page is cut into lines (its text
blocks).  Its lines are aligned with those of the neighbour that shares the longest
path prefix by a longest common subsequence; lines that both have are the site's
template and are deleted, inside ``article`` and ``main`` elements too.  Equal pages in
a row count once, and a neighbour that shares most of the text is a copy, not a
template, and is passed over for the next one.

Elements that HTML itself declares not to be main text (menus, headers, footers,
sidebars, forms, scripts, styles, and blocks classed as adverts, notices or
reader comments) never become candidate lines.  Where a page has an ``article``
or ``main`` element with text, lines outside of it are dropped as well, shared or not.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import pick, written

#: A neighbour that shares this part of the shorter page's text is a copy of it ...
COPY_SHARE = 0.6
#: ... judged without the lines that the pages around repeat, unless it shares as much as this.
SAME_SHARE = 0.9
#: Different pages on each side among which a neighbour that is no copy is looked for.
AROUND = 8
#: Most pages in a task, whatever the table (the bounds of all tasks' pages go to every task).
MOST_ROWS = 16_384

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|template|noscript|iframe|svg|textarea|select|title)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_BLOCK = frozenset("p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table thead tbody tfoot tr td th caption section "
                   "article main header footer nav aside form blockquote pre hr figure figcaption address "
                   "details summary body html head fieldset menu dialog center option button optgroup".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What may stand in a head; any other start tag, or text, ends it.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes head html".split())
_ENDS_P = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption "
                    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section "
                    "summary table ul".split())
_CELLS = ("td", "th", "caption")
_P_WITHIN = (*_CELLS, "table", "button")
_ROWS = ("thead", "tbody", "tfoot")
#: Start tag: the open elements that it ends, and those that it does not reach out of.
_IMPLIED = ({"li": (("li",), ("ul", "ol", "menu", *_CELLS)), "option": (("option",), ("select", "datalist", "optgroup")),
             "optgroup": (("option", "optgroup"), ("select", "datalist"))}
            | dict.fromkeys(("dt", "dd"), (("dt", "dd"), ("dl", *_CELLS)))
            | dict.fromkeys(("td", "th"), (("td", "th", "caption"), ("table",)))
            | {"tr": (("tr", *_CELLS), ("table",))}
            | dict.fromkeys(_ROWS, (("tr", *_CELLS, *_ROWS), ("table",))))
#: End tag: the open elements that it does not reach out of, if not cells.
_WITHIN = (dict.fromkeys((*_CELLS, *_ROWS, "tr"), ("table",))
           | dict.fromkeys(("table", "body", "html", "article", "main"), ()))
_APART = frozenset("nav footer aside form menu dialog button head".split())
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menus?|sidebar|breadcrumbs?|footer|header|"
    r"masthead|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|share|sharing|social|related|"
    r"comments?|disqus|repl(?:y|ies)|login|search|pagination|pager|widget|copyright)(?=$|[\s_-])", re.I)
#: Classes and ids that inside of an article or main element name no main text; whole names only.
_NAMES = frozenset("ad ads advert adverts advertisement advertising ad-container ad-slot banner sponsor sponsored promo "
                   "promotion nav navbar navigation menu sidebar breadcrumb breadcrumbs footer masthead cookie cookies "
                   "cookie-banner cookie-notice consent gdpr popup modal newsletter newsletter-signup subscribe "
                   "share-buttons social-share related-posts related-articles comment comments comment-list "
                   "comments-area disqus reply replies login pagination pager widget copyright".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())   # their ids are anchors, ...
_SECTIONS = _HEADINGS | {"section", "article"}             # ... and so are those inside of an article
_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


class Line(NamedTuple):
    """A text block; ``own``: inside an article or main element."""

    text: str
    own: bool


def _apart(tag: str, attrs: str, inside: int) -> bool:
    """Whether an element is declared to be something else than main text.

    Inside of an article or main element only whole class names (and ids, if no heading
    or section has them) count; doubtful words are left to the differencing.
    """
    if tag in _APART or tag == "header" and not inside:
        return True
    if tag in ("html", "body", "main") or tag in _VOID:
        return False
    for name, *values in _NAMED.findall(attrs):
        value = "".join(values)
        if name.lower() == "role":
            if value.lower() in _ROLE:
                return True
        elif inside:
            if (name.lower() == "class" or tag not in _SECTIONS) and not _NAMES.isdisjoint(value.lower().split()):
                if tag != "article" or re.search("comment|repl", value, re.I):
                    return True
        elif name.lower() == "id" and tag in _HEADINGS:
            continue
        elif _HINT.search(value) and (tag != "article" or re.search("comment|repl", value, re.I)):
            return True
    return False


def lines(page: str | None) -> list[Line]:
    """Text blocks of a page in order, without the elements set apart.

    Character references are decoded, white space becomes single blanks.  An element
    set apart ends at its end tag, at a tag that implies it (for those whose end tag
    HTML lets out), at the end tag of a block around it, and where an article begins;
    void elements have no content to set apart.
    """
    if not page:
        return []
    out: list[Line] = []
    parts: list[str] = []
    inside, at = 0, 0
    stack: list[str] = []          # open blocks, and whatever else is set apart or inside of that
    where: dict[str, list[int]] = {}   # places in the stack by tag
    apart = -1                     # place of the element set apart

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            out.append(Line(text, inside > 0))

    def last(tags: Iterable[str]) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=-1)

    def close(place: int) -> None:
        nonlocal apart
        while len(stack) > place:
            where[stack.pop()].pop()
        if place <= apart:
            apart = -1

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            if apart >= 0 and stack[apart] == "head" and page[at:m.start()].strip():
                close(apart)
            if apart < 0:
                parts.append(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        closes = bool(m["close"])
        if apart >= 0 and not closes:
            if stack[apart] == "head" and tag not in _IN_HEAD:
                close(apart)
            elif tag in ("article", "main") and stack[apart] not in ("aside", "section", "article"):
                close(apart)
        if apart < 0:
            if tag == "br":
                parts.append(" ")
            elif tag in _BLOCK:
                flush()
        if closes:
            place = last((tag,))
            if place >= 0 and place > last(_WITHIN.get(tag, _CELLS)):
                close(place)
            if apart < 0 and tag in ("article", "main"):
                inside = max(0, inside - 1)
            continue
        if tag in _ENDS_P:
            place = last(("p",))
            if place > last(_P_WITHIN):
                close(place)
        if tag in _IMPLIED:
            ended, within = _IMPLIED[tag]
            bound = last(within)
            places = [where[t][-1] for t in ended if where.get(t) and where[t][-1] > bound]
            if places:
                close(min(places))
        if tag in _VOID:
            continue
        if apart < 0 and not m["attrs"].endswith("/") and _apart(tag, m["attrs"], inside):
            flush()
            apart = len(stack)
        elif tag not in _BLOCK and (apart < 0 or tag != stack[apart]):
            continue
        where.setdefault(tag, []).append(len(stack))
        stack.append(tag)
        if apart < 0 and tag in ("article", "main"):
            inside += 1
    if at < len(page) and (apart < 0 or stack[apart] == "head" and page[at:].strip()):
        parts.append(page[at:])
    flush()
    return out


def common(a: list[str], b: list[str]) -> set[int]:
    """Positions of ``a`` in a longest common subsequence with ``b``.

    Bit-parallel: after each line of ``b`` one integer holds, for each prefix of
    ``a``, whether the subsequence grows there.  Lines that the other side lacks
    are left out first, so the integers are as long as the shared lines only.
    """
    in_a, in_b = set(a), set(b)
    at = [i for i, x in enumerate(a) if x in in_b]
    b = [x for x in b if x in in_a]
    if not at or not b:
        return set()
    where: dict[str, int] = {}
    for i, k in enumerate(at):
        where[a[k]] = where.get(a[k], 0) | 1 << i
    full = (1 << len(at)) - 1
    rows, v = [full], full
    for x in b:
        u = v & where[x]
        v = ((v + u) | (v - u)) & full
        rows.append(v)

    def length(i: int, j: int) -> int:
        return i - (rows[j] & ((1 << i) - 1)).bit_count()

    found, i, j = set(), len(at), len(b)
    while i and j:
        if rows[j] >> (i - 1) & 1:
            i -= 1
        elif length(i, j) == length(i, j - 1):
            j -= 1
        else:
            found.add(at[i - 1])
            i, j = i - 1, j - 1
    return found


class Page(NamedTuple):
    """A page, its lines and a hash of them."""

    page_id: int | None
    url: str | None
    host: str
    path: str
    lines: list[Line]
    digest: int


def _digest(page: list[Line]) -> int:
    text = "\n".join(("+" if x.own else "-") + x.text for x in page)
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _repeated(page: Page, near: list[Page], own: bool = False) -> set[str]:
    """Undeclared (``own``: declared) lines that more than half of the different pages
    around have too, and two at least."""
    around = {o.digest: {x.text for x in o.lines} for o in near if o.digest != page.digest}.values()
    return {t for t in {x.text for x in page.lines if x.own == own}
            if sum(t in o for o in around) > max(1, len(around) / 2)}


def shared_with(page: Page, others: list[Page]) -> set[int]:
    """Lines that the page shares with its nearest neighbour that is not a copy of it.

    ``others``: nearest first.  Lines that the pages around repeat do not make a copy,
    unless the two have hardly anything else.
    """
    mine = [x.text for x in page.lines]
    near = [o for o in others if o.host == page.host and page.host]
    repeated = None
    for other in sorted(near, key=lambda o: -_prefix(page.path, o.path)):
        if other.digest == page.digest:
            continue
        theirs = [x.text for x in other.lines]
        found = common(mine, theirs)
        size = min(sum(map(len, mine)), sum(map(len, theirs)))
        shared = sum(len(mine[i]) for i in found)
        if shared < COPY_SHARE * size:
            return found
        if shared < SAME_SHARE * size:
            if repeated is None:
                repeated = _repeated(page, near)
            rest = min(sum(len(x) for x in side if x not in repeated) for side in (mine, theirs))
            if sum(len(mine[i]) for i in found if mine[i] not in repeated) < COPY_SHARE * rest:
                return found
    return set()


def main_text(page: Page, others: list[Page]) -> str:
    """The page's own lines, joined by line feeds.

    Lines shared with the nearest neighbour go.  Inside of article and main two pages
    may say the same by chance (a headline, a sentence), so there a shared line goes only
    if most of the different pages around have it too: then it is the site's.  What is
    left and lies outside of article and main stays only if nothing lies inside of them.
    """
    shared = shared_with(page, others)
    if any(page.lines[i].own for i in shared):
        site = _repeated(page, [o for o in others if o.host == page.host and page.host], own=True)
        shared = {i for i in shared if not page.lines[i].own or page.lines[i].text in site}
    declared = any(x.own for x in page.lines)
    return "\n".join(x.text for i, x in enumerate(page.lines) if i not in shared and (x.own or not declared))


_KEY = ["host", "path", "page_id", "digest"]


def _order(host: str, path: str, page_id: int | None, digest: int) -> tuple:
    """The key as Spark orders it: a null id comes first."""
    return host, path, page_id is not None, page_id or 0, digest


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[Page]:
    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "host", "path", "html")]
        for k in range(batch.num_rows):
            page_id, url, host, path, text = (c[k].as_py() for c in columns)
            found = lines(text)
            yield Page(page_id, url, host, path, found, _digest(found))


def _packed(rows: Iterable[tuple], schema: pa.Schema, size=lambda row: 0) -> Iterator[pa.RecordBatch]:
    def pack() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], f.type) for i, f in enumerate(schema)],
                                          schema=schema)

    done, held = [], 0
    for row in rows:
        done.append(row)
        held += size(row)
        if len(done) >= 2000 or held > 8 << 20:
            yield pack()
            done, held = [], 0
    if done:
        yield pack()


_KEYS = pa.schema([("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("digest", pa.int64())])
_NUMBERED = pa.schema([*_KEYS, ("part", pa.int32()), ("idx", pa.int64()), ("first", pa.bool_()), ("nth", pa.int64())])
_DEALT = pa.schema([("block", pa.int32()), ("halo", pa.bool_()), *_KEYS, ("url", pa.string()),
                    ("lines", pa.list_(pa.string())), ("own", pa.list_(pa.bool_()))])
_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _packed(((p.host, p.path, p.page_id, p.digest) for p in _pages(batches)), _KEYS)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place in the sorted partition; ``first`` of a run of equal pages, and the ``nth`` run."""
    def rows() -> Iterator[tuple]:
        part, before, idx, nth = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            for host, path, page_id, digest in zip(*(batch.column(c).to_pylist() for c in _KEY)):
                first = (host, digest) != before
                before, nth = (host, digest), nth + first
                yield host, path, page_id, digest, part, idx, first, nth
                idx += 1

    return _packed(rows(), _NUMBERED)


def _deal(batches: Iterator[pa.RecordBatch], starts: list[tuple], halo: dict[tuple, list[int]]) -> Iterator[pa.RecordBatch]:
    """Each page to its block of the order, and to the blocks that it is an edge page of."""
    def rows() -> Iterator[tuple]:
        for p in _pages(batches):
            key = _order(p.host, p.path, p.page_id, p.digest)
            block = max(0, bisect_right(starts, key) - 1)
            for b in (block, *(h for h in halo.get(key, ()) if h != block)):
                yield (b, b != block, p.host, p.path, p.page_id, p.digest, p.url,
                       [x.text for x in p.lines], [x.own for x in p.lines])

    return _packed(rows(), _DEALT, lambda row: sum(map(len, row[7])))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Main text of the pages of a block in order, each with ``AROUND`` runs on both sides."""
    def pages() -> Iterator[tuple[bool, Page]]:
        for batch in batches:
            for r in batch.to_pylist():
                yield r["halo"], Page(r["page_id"], r["url"], r["host"], r["path"],
                                      [Line(*x) for x in zip(r["lines"], r["own"])], r["digest"])

    def texts(runs: list[list[tuple[bool, Page]]], at: int) -> Iterator[tuple]:
        others = [runs[j][0][1] for d in range(1, AROUND + 1) for j in (at - d, at + d) if 0 <= j < len(runs)]
        for edge, page in runs[at]:
            if not edge:
                yield page.page_id, page.url, main_text(page, others)

    def rows() -> Iterator[tuple]:
        runs, at = [], 0    # the last run may still grow
        for edge, page in pages():
            if runs and (page.host, page.digest) == (runs[-1][0][1].host, runs[-1][0][1].digest):
                runs[-1].append((edge, page))
                continue
            if len(runs) - 1 - at >= AROUND:
                yield from texts(runs, at)
                at += 1
                if at > AROUND:
                    runs.pop(0)
                    at -= 1
            runs.append([(edge, page)])
        for k in range(at, len(runs)):
            yield from texts(runs, k)

    return _packed(rows(), _TEXTS, lambda row: len(row[2]))


def main_texts(pages: DataFrame, block_rows: int | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; no html or no main text gives ''.

    Pages without a host (null or odd URLs) have no neighbours.  ``block_rows`` sets
    how many pages one task takes, not what comes out.
    """
    spark = pages.sparkSession
    p = pick(pages, page_id="page_id", url="url", html="html")
    url = F.coalesce("url", F.lit(""))
    keyed = p.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"), "html")
    keys = "host string, path string, page_id bigint, digest bigint"
    narrow = written(spark, keyed.mapInArrow(_keys, keys), "html-keys")
    numbered = written(spark, narrow.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(
        _number, f"{keys}, part int, idx bigint, first boolean, nth bigint"), "html-order")
    ends = numbered.groupBy("part").agg(
        F.count("*").alias("n"), F.max("nth").alias("runs"), F.min_by(F.struct("host", "digest"), "idx").alias("head"),
        F.max_by(F.struct("host", "digest"), "idx").alias("tail")).orderBy("part").collect()
    offsets, total, runs, tail = [], 0, 0, None
    for e in ends:      # a run may go on over the end of a partition
        same = int(e.head == tail)
        offsets.append((e.part, total, runs - same, same))
        total, runs, tail = total + e.n, runs + e.runs - same, e.tail
    size = block_rows or max(256, min(MOST_ROWS, -(-total // 1000)))
    placed = (numbered.join(F.broadcast(spark.createDataFrame(offsets, "part int, rows long, runs long, same int")), "part")
              .select(*_KEY, (F.col("rows") + F.col("idx")).alias("place"), (F.col("runs") + F.col("nth")).alias("run"),
                      (F.col("first") & ~((F.col("idx") == 0) & (F.col("same") == 1))).alias("first")))
    starts = sorted(_order(*r) for r in placed.filter(F.col("place") % size == 0).select(*_KEY).collect())
    around = [(r.block, k) for r in placed.groupBy(F.floor(F.col("place") / size).alias("block"))
              .agg(F.min("run").alias("lo"), F.max("run").alias("hi")).collect()
              for k in {*range(r.lo - AROUND, r.lo + 1), *range(r.hi, r.hi + AROUND + 1)}]
    halo: dict[tuple, list[int]] = {}
    for r in (placed.filter("first").join(F.broadcast(spark.createDataFrame(around, "block long, run long")), "run")
              .select(*_KEY, "block").collect()):
        halo.setdefault(_order(*r[:4]), []).append(r.block)
    dealt = keyed.mapInArrow(partial(_deal, starts=starts, halo=halo),
                             f"block int, halo boolean, {keys}, url string, lines array<string>, own array<boolean>")
    return (dealt.repartitionById(max(1, len(starts)), "block").sortWithinPartitions(*_KEY, "halo")
            .mapInArrow(_extract, "page_id bigint, url string, text string")
            .withColumn("n_chars", F.length("text").cast("bigint")))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: main text of every row of ``pages``."""
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
