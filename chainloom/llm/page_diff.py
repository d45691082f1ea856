"""Main text of pages: each page is set against the page of its host with the nearest URL.

A page is cut into lines, one for each block of text. Lines that a longest common subsequence shares with the
nearest page that is no copy are the template's and are deleted. A line inside the page's article element may be prose
that articles share, and goes only where it is common on the host and the two nearest pages, which are no copies of one
another either, both have it at its place. What no neighbour shows is judged by the markup: menus, footers,
forms, adverts, comments and so on by the names of elements and classes.

A line on at least half of the different pages of a host, and on three, is common there. Copies are told by their
other lines. Pages are ordered by (host, path, page_id, html), and a run of pages that have the same lines, but for
common ones, counts as one neighbour, however long it is. A first job over marks of lines finds the common lines, the
order's ranges and the pages at their edges; in the main job each range gets those pages of its neighbours besides its
own, so that every page meets the same neighbours however the ranges fall, and no host, however large, has to fit in
one task.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm import scratch

#: Two pages of which more than this share of lines, but for the host's common ones, is equal are copies, and the next
#: neighbour is taken.
COPY_SHARE = 0.9
#: Neighbours (runs of pages) looked at on each side.
REACH = 2
#: A line is common on a host from so many different pages and this share of them on.
COMMON_PAGES, COMMON_SHARE = 3, 0.5

# comments, sections of character data, declarations and tags; a tag in which a quote stays open ends at its first bracket
_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|\"[^\"<>]*\"|'[^'<>]*'|[^'\"<>])*+(?=>|$)|[^<>]*)(?:>|$|(?=<))", re.S)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
# Fixed sets of element and class names.
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "object", "svg", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
_OUT = {"nav", "header", "footer", "aside", "form", "head", "title", "menu", "button", "select", "dialog", "fieldset", "option"}
_OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar", "form"}
_OUT_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "discussion", "footer", "gdpr", "header", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "promoted", "related", "recommended", "replies", "reply", "respond", "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget"}
#: Words that say nothing for themselves: "site-header" is a header, "market-share" is no bar for sharing.
_PLACE_WORDS = {"area", "article", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "desktop", "entry", "fixed", "form", "global", "group", "icon", "icons", "inline", "inner", "item", "items", "js", "left", "link", "links", "list", "main", "message", "mobile", "outer", "overlay", "page", "panel", "policy", "post", "primary", "right", "secondary", "section", "site", "slot", "sticky", "text", "thread", "top", "unit", "wrap", "wrapper"}
#: Elements of an article's own text, which a single word of a class makes something else only if it is one of these:
#: a paragraph of class "share" or "reply" may be about shares or quote a reply.
_PROSE = {"p", "blockquote", "q", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "li", "dd", "dt", "td", "th", "figcaption"}
_PROSE_OUT = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "breadcrumb", "breadcrumbs", "cookie", "cookies", "newsletter", "pager", "pagination", "promo", "promoted", "sponsor", "sponsored"}
#: Words and elements that inside an article belong to it: its own headline.
_HEAD_WORDS = {"header", "masthead"}
_MAIN_WORDS = {"article", "articlebody", "entry-content", "post-content", "article-content", "article-body", "post-body", "main-content", "story-body"}


def _kind(name: str, attributes: str, inside: bool = False) -> int:
    """1: the article, -1: something else, 0: neither says. ``inside``: the element lies in an article."""
    if name in _OUT and not (inside and name in _HEAD_WORDS):
        return -1
    whole = set()
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "role":
                if value in _OUT_ROLES:
                    return -1
                if value in ("main", "article"):
                    return 1
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                return -1
            elif key in ("class", "id"):
                whole.update(value.split())
    if name == "body" or name == "html":
        return 0
    out = _OUT_WORDS - _HEAD_WORDS if inside else _OUT_WORDS
    for w in whole:
        parts = set(re.split(r"[-_]+", w)) - {""}
        if parts & out and parts <= out | _PLACE_WORDS and not (inside and name in _PROSE and len(parts) == 1 and not parts & _PROSE_OUT):
            return -1
    if name in ("article", "main") or whole & _MAIN_WORDS:
        return 1
    return 0


def lines(page: str | None) -> list[tuple[str, int]]:
    """Text of each block with 1 for the article's own, -1 for what the markup names as something else, 0 for the rest.

    As in browsers, "<" with a letter behind it begins a tag: what follows in ``a<b`` belongs to the tag.
    """
    page = page or ""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    open_names: Counter[str] = Counter()  # of the stack, so that no tag has to search it in vain
    parts: list[str] = []
    state, at = 0, 0

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append((text, state))
            parts.clear()

    position = _TAG.search(page)
    while position is not None:
        if position.start() > at:
            parts.append(page[at : position.start()])
        at = position.end()
        name = (position[2] or "").lower()
        if name and position[1]:
            if name in _BLOCK:
                flush()
            while open_names[name]:
                closed, before = stack.pop()
                open_names[closed] -= 1
                if closed == name:
                    if state != before:
                        flush()
                    state = before
                    break
        elif name:
            if name in _BLOCK:
                flush()
            if name == "br":
                parts.append(" ")
            if name == "svg" and (position[3] or "").endswith("/"):
                pass  # the one raw element that may end at once
            elif name in _RAW:
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            elif name not in _VOID and not (position[3] or "").endswith("/"):
                if name == "p" and stack and stack[-1][0] == "p":
                    state = stack.pop()[1]
                    open_names["p"] -= 1
                kind = _kind(name, position[3] or "", state == 1)
                inner = -1 if state == -1 or kind == -1 else max(state, kind)
                if inner != state or name in _BLOCK or open_names[name]:
                    if inner != state:
                        flush()
                    stack.append((name, state))
                    open_names[name] += 1
                    state = inner
        position = _TAG.search(page, at)
    parts.append(page[at:])
    flush()
    return out


def shared(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Rows of the length table are kept as differences in the bits of integers, one bit for each line of ``b``.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(head), *range(len(a) - tail, len(a))}
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    where: dict[str, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows, row = [], full  # a zero bit at j: the length grows at j
    for line in x:
        match = where.get(line, 0)
        row = ((row + (row & match)) | (row & ~match)) & full
        rows.append(row)
    j = len(y)
    for i in range(len(x) - 1, -1, -1):
        above = rows[i - 1] if i else full
        # the last place up to j at which this row's length grows
        grown = ~rows[i] & ((1 << j) - 1)
        if not grown:
            break
        last = grown.bit_length() - 1
        length, length_above = grown.bit_count(), (~above & ((1 << j) - 1)).bit_count()
        if length > length_above:
            match = where.get(x[i], 0) & ((1 << j) - 1)
            while match:  # the match that gave the growth: the last with enough length before it
                k = match.bit_length() - 1
                if (~above & ((1 << k) - 1)).bit_count() == length - 1:
                    found.add(head + i)
                    j = k
                    break
                match &= ~(1 << k)
        elif last < 0:
            break
    return found


def mark(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def marks(page: list[tuple[str, int]]) -> list[int]:
    """Sorted marks of the distinct lines that the markup does not name as something else."""
    return sorted({mark(t) for t, k in page if k >= 0})


def main_text(own: list[tuple[str, int]], others: list[list[tuple[str, int]]], common: frozenset[int] = frozenset()) -> str:
    """Lines of a page without those that the nearest pages that are no copies, or its markup, show to be template.

    Copies are told by the lines that are neither ``common`` on the host (marks) nor named as something else by the
    markup. A page that meets copies only loses the host's common lines, and what its markup sets beside an article; one
    that has no line of its own besides common ones, or no neighbour, is judged by its markup alone.
    """

    def telling(page: list[tuple[str, int]]) -> list[str]:
        return [t for t, k in page if k >= 0 and not (common and mark(t) in common)]

    def are_copies(a: list[str], b: list[str]) -> bool:
        return len(shared(a, b)) > COPY_SHARE * max(1, min(len(a), len(b)))

    texts, left = [t for t, _ in own], telling(own)
    has_article = any(k == 1 for _, k in own)
    met: list[set[int]] = []  # of one neighbour, or of two different ones, what they share with the page
    before: list[str] = []
    for other in others if left else []:
        if all(k < 0 for _, k in other):  # shows nothing
            continue
        theirs = telling(other)
        if are_copies(left, theirs) or met and are_copies(before, theirs):
            continue
        met.append(shared(texts, [t for t, _ in other]))
        before = theirs
        if len(met) == 2 or not has_article:
            break
    if met:
        twice = met[0] & met[1] if len(met) == 2 else set()
        gone = {i for i, (t, k) in enumerate(own) if (i in twice and mark(t) in common if k == 1 else i in met[0])}
        return "\n".join(t for i, (t, k) in enumerate(own) if k >= 0 and i not in gone)
    gone = common if left and others else frozenset()
    return "\n".join(t for t, k in own if (k == 1 or k == 0 and not has_article) and not (gone and mark(t) in gone))


def _common(a: str, b: str) -> int:
    """Characters that two paths begin with alike."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null or empty html has an empty text; a null url belongs to the host and path of the empty one. A page of any
    length is read whole, by one task. Repeated rows count as one neighbour. A page without neighbours is judged by its
    markup alone. An empty table gives an empty result; other columns of ``pages`` are not read.
    """
    spark = pages.sparkSession
    scratch.ship(spark)
    link = F.coalesce("url", F.lit(""))
    key = [F.lower(F.regexp_extract(link, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"), F.regexp_extract(link, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"), F.coalesce("page_id", F.lit(-1)).cast("long").alias("id"), F.xxhash64("html").alias("html_hash")]
    marked = scratch.keep(pages.select(*key, "html").mapInArrow(_marked, "host string, path string, id bigint, html_hash bigint, marks array<bigint>"), "marks")
    common = scratch.keep(_common_lines(marked), "common-lines")
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * scratch.input_partitions(pages))
    order = ["host", "path", "id", "html_hash"]
    telling = F.xxhash64(F.array_except("marks", F.coalesce("common", F.array().cast("array<bigint>"))))
    thin = marked.join(common, "host", "left").select(*order, telling.alias("telling"))
    edges = thin.repartitionByRange(count, *order).sortWithinPartitions(*order).mapInArrow(_edges, "host string, path string, id bigint, html_hash bigint, telling bigint, part int, place int").collect()
    ranges: dict[int, dict[int, tuple[tuple, tuple]]] = {}
    for r in edges:  # REACH + 1 runs from each end of each range, the last one's last page at -1
        ranges.setdefault(r["part"], {})[r["place"]] = ((r["host"], r["path"], r["id"], r["html_hash"]), (r["host"], r["telling"]))
    parts = sorted(ranges, key=lambda p: ranges[p][-1][0])
    lasts = [ranges[p][-1][0] for p in parts]
    for_others: dict[tuple, set[int]] = {}
    for n, p in enumerate(parts):
        for step in (-1, 1):  # nearest pages of the runs before and after the range, from as many ranges as that takes
            seen: list[tuple] = []
            host, m = ranges[p][-1 if step > 0 else 1][0][0], n + step
            while 0 <= m < len(parts) and len(seen) <= REACH + 1:
                for place in sorted((k for k in ranges[parts[m]] if k * step > 0), key=abs):
                    k, run = ranges[parts[m]][place]
                    if run[0] != host:
                        m = -2  # no page of another host is a neighbour
                        break
                    if not seen or seen[-1] != run:
                        seen.append(run)
                        if len(seen) <= REACH + 1:
                            for_others.setdefault(k, set()).add(n)
                m += step
    known = spark.sparkContext.broadcast((lasts, for_others))  # a few keys for each range

    @F.pandas_udf("array<int>")
    def places(host: pd.Series, path: pd.Series, page: pd.Series, html_hash: pd.Series) -> pd.Series:
        last, more = known.value
        out = []
        for k in zip(host, path, page, html_hash, strict=True):
            own = min(bisect_left(last, k), len(last) - 1)
            out.append([own, *sorted(more.get(k, ()))])
        return pd.Series(out)

    full = pages.select(*key, "page_id", "url", "html")
    full = full.withColumn("places", places(*order)).withColumn("place", F.explode("places"))
    full = full.withColumn("own", F.col("place") == F.element_at("places", 1)).drop("places")
    full = full.join(common, "host", "left")
    dealt = full.repartitionById(count, "place").sortWithinPartitions("place", *order)
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window: list[dict] = []  # runs around the current one, of one range, in order
        done = 0

        def finish(final: bool) -> Iterator[dict]:
            nonlocal done
            while done < len(window) and (final or done + REACH + 1 < len(window)):
                current = window[done]
                near = [k for k in range(max(0, done - REACH), min(len(window), done + REACH + 1)) if k != done and window[k]["host"] == current["host"]]
                nearest = {k: window[k]["last" if k < done else "first"] for k in near}
                texts: dict[tuple, str] = {}
                for page in current["pages"]:
                    rank = tuple(sorted(near, key=lambda k: (-_common(page["path"], nearest[k]["path"]), abs(k - done), k)))
                    text = texts.get((page["lines"], rank))
                    if text is None:
                        text = texts[page["lines"], rank] = main_text(page["lines"], [nearest[k]["lines"] for k in rank], current["common"])
                    yield {"page_id": page["page_id"], "url": page["url"], "text": text, "n_chars": len(text)}
                current["pages"] = []
                done += 1
                if done > REACH:
                    window.pop(0)
                    done -= 1

        def add(row: dict) -> None:
            own = tuple(lines(row["html"]))
            common = window[-1]["common"] if window and window[-1]["host"] == row["host"] else frozenset(row["common"] or ())
            telling = tuple(m for m in marks(own) if m not in common)
            page = {"path": row["path"], "lines": own, "page_id": row["page_id"], "url": row["url"]}
            if not window or (window[-1]["host"], window[-1]["telling"]) != (row["host"], telling):
                window.append({"host": row["host"], "telling": telling, "common": common, "first": page, "pages": [], "known": {}})
            page["lines"] = window[-1]["known"].setdefault(own, own)  # equal pages hold their lines once
            window[-1]["last"] = page
            if row["own"]:
                window[-1]["pages"].append(page)

        schema = pa.schema([("page_id", pa.int32() if kind == "int" else pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
        place = None
        out: list[dict] = []
        for batch in batches:
            for row in (r for lo in range(0, batch.num_rows, 256) for r in batch.slice(lo, 256).to_pylist()):
                if row["place"] != place:
                    out.extend(finish(True))
                    window, done, place = [], 0, row["place"]
                add(row)
                for text in finish(False):
                    out.append(text)
                    if len(out) >= 256:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
        for text in finish(True):
            out.append(text)
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return dealt.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def _common_lines(marked: DataFrame) -> DataFrame:
    """host and marks of its common lines, of hosts that have some. Pages with equal lines count once."""
    pages = marked.where("size(marks) > 0").withColumn("whole", F.xxhash64("marks"))
    counts = pages.dropDuplicates(["host", "whole"]).select("host", F.explode("marks").alias("mark")).groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON_PAGES)
    sizes = pages.select("host", "whole").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    return counts.join(sizes, "host").where(F.col("n") >= COMMON_SHARE * F.col("pages")).groupBy("host").agg(F.collect_list("mark").alias("common"))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            found = pa.array([marks(lines(h.as_py())) for h in part.column(4)], type=pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:4], found], names=["host", "path", "id", "html_hash", "marks"])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of the first and last runs of a task's sorted keys that are nearest to its front (1, 2, ...) and back (-1, -2, ...)."""
    from pyspark import TaskContext

    first: list[dict] = []
    last: list[dict] = []

    def same(a: dict, b: dict) -> bool:
        return (a["host"], a["telling"]) == (b["host"], b["telling"])

    for batch in batches:
        for r in batch.to_pylist():
            if last and same(last[-1], r):
                last[-1] = r
                continue
            if len(first) <= REACH:
                first.append(r)
            last = [*last[-REACH:], r]
    part = TaskContext.get().partitionId()
    rows = [{**r, "part": part, "place": i} for i, r in enumerate(first, 1)] + [{**r, "part": part, "place": -i} for i, r in enumerate(reversed(last), 1)]
    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("host", pa.string()), ("path", pa.string()), ("id", pa.int64()), ("html_hash", pa.int64()), ("telling", pa.int64()), ("part", pa.int32()), ("place", pa.int32())]))
