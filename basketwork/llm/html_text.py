"""Main text of web pages: marked zones, and page differencing against the nearest URL of the host."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import stored
from basketwork.session import checkpointed

# Fixed values of the format: elements whose text is no part of an article.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
FURNITURE = RAW | {
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "template", "svg", "math", "canvas",
    "object", "audio", "video", "dialog", "menu", "label", "input",
}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
FURNITURE_WORDS = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|"
    r"signup|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|disqus|respond|replies|share|sharing|"
    r"social|related|recommended|widgets?|pagination|pager|skip"
)
# What may stand beside furniture words in a name such as `ad-box`; any other word, as in `has-sidebar`, speaks of the page.
PLACES = re.compile(
    r"site|global|page|top|bottom|left|right|primary|secondary|main|mobile|sticky|fixed|box|bar|block|list|items?|links?|wrap|wrapper|"
    r"container|section|area|inner|outer|slot|unit|policy|message|form|buttons?|posts?|articles?|\d+"
)
READERS = re.compile(r"comments?|disqus|respond|replies")
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
    "q", "ruby", "rb", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}

# Elements that may be a part of their own in an article, if they have a class or id.
UNITS = {"div", "section", "ul", "ol", "dl", "table", "figure", "center", "fieldset", "details"}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
FURNITURE_ZONE, OUTSIDE_ZONE, ARTICLE_ZONE = 0, 1, 2


def _tokens(page: str) -> list[tuple]:
    """Runs of text (decoded) and tags (closing, name, attributes) of a page; raw text and comments left out."""
    tokens, at, size = [], 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            tokens.append((html.unescape(page[at:]),))
            break
        if m.start() > at:
            tokens.append((html.unescape(page[at : m.start()]),))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in RAW and not m[1]:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else size
            tokens.append((False, "p", ""))  # a boundary between blocks
            continue
        tokens.append((bool(m[1]), name, m[3]))
    return tokens


def _is_furniture(name: str, attributes: str) -> bool:
    if name in FURNITURE:
        return True
    if name in ("html", "body", "main", "article"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value in FURNITURE_ROLES:
                return True
        elif any(_names_furniture(token) for token in value.split()):
            return True
    return False


def _has_name(attributes: str) -> bool:
    return any(m[1].lower() != "role" and (m[2] or m[3] or m[4] or "").strip() for m in _ATTRIBUTE.finditer(attributes))


def _names_furniture(token: str) -> bool:
    """Whether a class or id is a furniture word, alone or with words of place: `sidebar`, `site-footer`, not `has-sidebar`."""
    parts = [p for p in re.split(r"[-_]+", token) if p]
    known = [bool(FURNITURE_WORDS.fullmatch(p)) for p in parts]
    return any(known) and all(k or PLACES.fullmatch(p) for k, p in zip(known, parts))


class _Measures:
    """Running counts over a page's tokens: letters of text, and starts of articles."""

    def __init__(self, tokens: list[tuple]):
        self.letters, self.articles = [0], [0]
        for t in tokens:
            self.letters.append(self.letters[-1] + (len("".join(t[0].split())) if len(t) == 1 else 0))
            self.articles.append(self.articles[-1] + (len(t) == 3 and not t[0] and _is_article(t[1], t[2])))

    def holds_the_text(self, start: int, end: int, attributes: str) -> bool:
        """Whether an element named as furniture holds an article, or most of the page's text and is not readers' comments."""
        if self.articles[end] > self.articles[start + 1]:
            return True
        if any(READERS.search((m[2] or m[3] or m[4] or "").lower()) for m in _ATTRIBUTE.finditer(attributes)):
            return False
        return (self.letters[end] - self.letters[start + 1]) * 2 > self.letters[-1]


def _is_article(name: str, attributes: str) -> bool:
    if name in ("article", "main") or "role" not in attributes.lower():
        return name in ("article", "main")
    roles = ((m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() == "role")
    return any(r in ("main", "article") for r in roles)


def _closing(tokens: list[tuple]) -> dict[int, int]:
    """Of each opening tag that is closed: where."""
    open_, found = defaultdict(list), {}
    for i, t in enumerate(tokens):
        if len(t) == 3:
            if not t[0]:
                if t[1] not in VOID:
                    open_[t[1]].append(i)
            elif open_[t[1]]:
                found[open_[t[1]].pop()] = i
    return found


def page_blocks(page: str | None) -> list[tuple[str, int, int]]:
    """Blocks of a page's text in order, white space as one blank, each with its zone and its unit.

    Article: inside article, main or their roles. Furniture: inside menus, headers, footers,
    sidebars, notices, adverts, forms, comments, by element, role, or a whole class or id; an element that is
    never closed marks nothing, nor does one that only by its name is furniture and holds an article or most of
    the page's text. Outside: the rest. Unit: the innermost element of `UNITS` inside the article that has a class
    or id and is closed, numbered from 1; 0 is none.
    """
    tokens = _tokens(page or "")
    closes, lines, run, measures = _closing(tokens), [], [], None
    furniture_until, article_until, zone, units, inside = -1, -1, OUTSIDE_ZONE, 0, []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            lines.append((text, zone, inside[-1][1] if inside and zone == ARTICLE_ZONE else 0))
        run.clear()

    for i, t in enumerate(tokens):
        if len(t) == 1:
            run.append(t[0])
            continue
        closing, name, attributes = t
        if name not in INLINE:
            flush()
        if not closing:
            if i in closes and i > furniture_until and _is_furniture(name, attributes):
                # inside an article, and by element, the name alone decides
                if name in FURNITURE or i < article_until or not (measures := measures or _Measures(tokens)).holds_the_text(i, closes[i], attributes):
                    flush()
                    furniture_until = closes[i]
            if name in UNITS and furniture_until < i < article_until and i in closes and _has_name(attributes):
                units += 1
                inside.append((closes[i], units))
            if i > article_until and _is_article(name, attributes):
                article_until = closes.get(i, len(tokens))
        elif i == furniture_until:
            flush()
        while inside and inside[-1][0] <= i:
            inside.pop()
        now = FURNITURE_ZONE if i < furniture_until else ARTICLE_ZONE if i < article_until else OUTSIDE_ZONE
        if now != zone:
            flush()
            zone = now
    flush()
    return lines


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """The blocks of `page_blocks` with their zones alone."""
    return [(text, zone) for text, zone, _ in page_blocks(page)]


def candidates(blocks: list[tuple[str, int, int]]) -> list[int]:
    """Places of the blocks that may be text: those of the article, or, on a page without one, those outside furniture."""
    wanted = ARTICLE_ZONE if any(z == ARTICLE_ZONE for _, z, _ in blocks) else OUTSIDE_ZONE
    return [i for i, (_, z, _) in enumerate(blocks) if z == wanted]


def without_shared(places: list[int], article: bool, units: list[int], letters: list[int], shared: list[int]) -> list[int]:
    """Which of a page's candidates go, as places in `places`, when the blocks at `shared` are also on the nearest page.

    On a page without an article all shared ones go. In an article, whose first lines often recur, they go where they
    are a whole unit, such as a box for subscribers under a name that says nothing; not if such units hold over half
    of the article, as they do on copies of one article.
    """
    common = set(shared)
    if not article:
        return [k for k, i in enumerate(places) if i in common]
    own = {units[i] for i in places if i not in common}
    gone = [k for k, i in enumerate(places) if units[i] and units[i] not in own]
    of = lambda ks: sum(letters[places[k]] for k in ks)
    return gone if 2 * of(gone) <= of(range(len(places))) else []


def url_key(url: str | None) -> tuple[str, str]:
    """Host and path of a URL, in lower case, without query, fragment, `.html` and last slash; no host if there is none to read."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), re.sub(r"(\.html?)?/*$", "", parts.path.lower())
    except ValueError:
        return "", url or ""


def common_lines(own: list[int], other: list[int]) -> list[int]:
    """Places in `own` of a longest common subsequence with `other`.

    Equal ends are taken first; between them, matching places are threaded into a longest
    increasing chain.
    """
    head = 0
    while head < min(len(own), len(other)) and own[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(len(own), len(other)) - head and own[-1 - tail] == other[-1 - tail]:
        tail += 1
    places = defaultdict(list)
    for j in range(len(other) - tail - 1, head - 1, -1):
        places[other[j]].append(j)
    ends, chain = [], []
    for i in range(head, len(own) - tail):
        for j in places.get(own[i], ()):
            k = bisect_left(ends, j)
            link = (i, chain[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chain.append(link)
            else:
                ends[k], chain[k] = j, link
    middle, link = [], chain[-1] if chain else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(head), *middle[::-1], *range(len(own) - tail, len(own))]


KEY = ["page_id", "url", "digest"]
OUTLINE = "page_id long, url string, digest long, host string, path string, hashes array<long>, places array<int>, article boolean, units array<int>, letters array<int>"


def _hashed(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What differencing needs of each page: a hash of every block, which are candidates, their units and letters."""
    names, lists = [c.split()[0] for c in OUTLINE.split(", ")], pa.list_(pa.int32())
    types = (pa.string(), pa.string(), pa.list_(pa.int64()), lists, pa.bool_(), lists, lists)
    for batch in batches:
        columns = [[] for _ in types]
        for url, page in zip(batch["url"].to_pylist(), batch["html"]):
            blocks = page_blocks(page.as_py())
            texts, zones, units = zip(*blocks) if blocks else ((), (), ())
            row = (*url_key(url), [*map(_hashed, texts)], candidates(blocks), ARTICLE_ZONE in zones, units, [len(t) - t.count(" ") for t in texts])
            for column, value in zip(columns, row):
                column.append(value)
        yield pa.record_batch([*(batch[k] for k in KEY), *map(pa.array, columns, types)], names)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each page's candidates."""
    for batch in batches:
        found = []
        for page in batch["html"]:
            blocks = page_blocks(page.as_py())
            found.append([blocks[i][0] for i in candidates(blocks)])
        yield pa.record_batch([*(batch[k] for k in KEY), pa.array(found, pa.list_(pa.string()))], [*KEY, "lines"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last row of a partition, and the nearest to each of another path."""
    part, found = TaskContext.get().partitionId(), {}
    for row in _rows(batches):
        key = (row["host"], row["path"])
        found.setdefault("first", row)
        first = found["first"]
        if "after" not in found and key != (first["host"], first["path"]):
            found["after"] = row
        last = found.get("last")
        if last and key != (last["host"], last["path"]):
            found["before"] = last
        found["last"] = row
    if found:
        rows = list(found.items())
        yield pa.record_batch(
            [pa.array([part] * len(rows), pa.int32()), pa.array([k for k, _ in rows]), *(pa.array([r[c] for _, r in rows], t) for c, t in (("host", pa.string()), ("path", pa.string()), ("hashes", pa.list_(pa.int64()))))],
            ["part", "kind", "host", "path", "hashes"],
        )


def _pairer(before: dict[int, list[dict]], after: dict[int, list[dict]]):
    """Candidates that go from each page for its nearest page; `before`, `after`: rows next to each partition."""

    def prefix(a: str, b: str) -> int:
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    def gone(row: dict, around: list[dict | None]) -> list[int]:
        near = [r for r in around if r and row["host"] and r["host"] == row["host"] and r["path"] != row["path"]]
        if not near:
            return []
        partner = max(near, key=lambda r: prefix(r["path"], row["path"]))
        return without_shared(row["places"], row["article"], row["units"], row["letters"], common_lines(row["hashes"], partner["hashes"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: list[dict] = []  # pages of the path at hand, until the next path is known
        earlier, last = None, None

        def other_path(rows: list[dict], row: dict) -> dict | None:
            return next((r for r in rows if (r["host"], r["path"]) != (row["host"], row["path"])), None)

        def settled(following: dict | None) -> Iterator[pa.RecordBatch]:
            rows = [(*(r[k] for k in KEY), gone(r, [earlier, following])) for r in waiting]
            waiting.clear()
            rows = [r for r in rows if r[-1]]
            if rows:
                types = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()))
                yield pa.record_batch([*map(pa.array, zip(*rows), types)], [*KEY, "gone"])

        for row in _rows(batches):
            if last is None:
                earlier = other_path(before.get(part, []), row)
            elif (row["host"], row["path"]) != (last["host"], last["path"]):
                yield from settled(row)
                earlier = last
            last = row
            if row["places"]:
                waiting.append(row)
        if waiting:
            yield from settled(other_path(after.get(part, []), last))

    return run


def _neighbours(edges: list) -> tuple[dict[int, list[dict]], dict[int, list[dict]]]:
    """Per partition: the two last rows, of two paths, before it, and the two first ones after it."""
    by_part: dict[int, dict[str, dict]] = defaultdict(dict)
    for e in edges:
        by_part[e["part"]][e["kind"]] = {"host": e["host"], "path": e["path"], "hashes": list(e["hashes"] or [])}

    def fold(parts: list[int], near: str, far: str) -> dict[int, list[dict]]:
        found, carried = {}, []
        for p in parts:
            found[p] = carried
            own = [by_part[p][k] for k in (near, far) if k in by_part[p]]
            carried = [*own, *(c for c in carried if (c["host"], c["path"]) != (own[0]["host"], own[0]["path"]))][:2]
        return found

    return fold(sorted(by_part), "last", "before"), fold(sorted(by_part, reverse=True), "first", "after")


def differences(rows: DataFrame) -> DataFrame:
    """page_id, url, digest, gone: for pages that lose any, the places of candidates that go for the nearest page.

    All pages stand in order of host, path and row in range partitions, so a large host is many
    partitions. A page's partner is, of the pages of another path next to its own in that order,
    the one whose path agrees with it longer. Of each partition's edges, four rows come to the
    driver, for partners across the border. Only hashes of blocks are dealt out, no text.
    """
    outline = rows.mapInArrow(_outlines, OUTLINE)
    order = ["host", "path", *KEY]
    ordered = checkpointed(outline.repartitionByRange(*order).sortWithinPartitions(*order))
    edges = ordered.mapInArrow(_edges, "part int, kind string, host string, path string, hashes array<long>").collect()
    found = ordered.mapInArrow(_pairer(*_neighbours(edges)), "page_id long, url string, digest long, gone array<int>")
    return stored(found.dropDuplicates(KEY), "differences")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row: blocks of the article, in order, joined by a blank.

    Every page is aligned with the nearest page of its host by the longest common subsequence of their blocks; what
    is shared is deleted, checked by the marks of the page. Blocks in article or main elements are the text, but for
    furniture inside them and for shared units (`without_shared`); a page without such an element keeps the blocks outside furniture that
    are not shared. Null, empty and textless pages have empty text; a page alone in its host has
    nothing deleted, nor has a page whose URL is null or names no host. Rows are kept as they are, repeated and null ids included; columns other
    than page_id, url and html are ignored; an empty table gives none. Pages are read twice, so that no text is stored.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.withColumn("digest", F.xxhash64("html"))
    texts = rows.mapInArrow(_candidates, "page_id long, url string, digest long, lines array<string>")
    gone = differences(rows).select(*(F.col(k).alias(f"_{k}") for k in KEY), "gone")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    joined = texts.join(gone, same[0] & same[1] & same[2], "left")
    kept = F.filter("lines", lambda _, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    return joined.select("page_id", "url", F.array_join(kept, " ").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
