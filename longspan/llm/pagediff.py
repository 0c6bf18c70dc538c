"""Main text of web pages by markup and by nearest-URL page differencing.

A page becomes text lines, one for each block of its markup, each known to stand in the article, in site furniture (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments, told by element and by class, id or role) or in neither.
Pages of a host are sorted by URL path, those with the same lines being one; a page's partner is the neighbour with the longer
common path that does not hold nearly all of its lines, for a copy would take the text away with the furniture. Both pages' lines are
aligned by longest common subsequence, and shared lines, being furniture that the markup does not name, are deleted. This decides
on every line that stands in neither furniture nor a named article, also on pages that name one: an element called article may be a
teaser or hold but a part of the text. Lines of a named article stay: two articles may well share a sentence, and nothing of an
article is dropped. Where an article is named and no partner tells, unnamed lines beside it are taken for furniture.

Only hashes of lines are sorted, so a host with a third of all pages is dealt out like any other rows; the neighbours of a
partition's first and last page come from the partitions beside it. Pages
are parsed once for the hashes and once for the text, which moves compressed: that costs less disk than keeping the lines. Null
and empty pages have an empty text, and a page without partner and article keeps all lines that are no furniture. Rows are kept one to one;
other columns take no part, whatever their names.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from longspan.llm.words import map_batches, map_blocks
from longspan.session import pin

BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
SILENT = frozenset("audio canvas datalist head iframe math noembed noframes noscript object script style svg template title video".split())
RAW = frozenset("script style textarea title".split())
FURNITURE = frozenset("aside button dialog footer form header label menu nav optgroup option select textarea".split())
ARTICLE = frozenset(("article", "main"))
#: Words of a class, id or role that name furniture.
NAMED = frozenset(
    "ad ads adbox advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments commentlist complementary consent "
    "contentinfo cookie cookies dialog disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "notification pagination popup promo promoted promotion related search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
PLAIN, IN_ARTICLE, IN_FURNITURE = 0, 1, 2


@dataclass
class Line:
    text: str
    zone: int


def _is_named(attributes: str) -> bool:
    for m in _ATTRIBUTE.finditer(attributes):
        value = html.unescape(m[2] or m[3] or m[4] or "").lower()
        for name in value.split():
            parts = _NAME.findall(name)
            if parts and (parts[0] in NAMED or parts[-1] in NAMED):
                return True
    return False


def page_lines(page: str) -> list[Line]:
    """The blocks of a page in order, white space as one space, without empty ones."""
    lines: list[Line] = []
    parts: list[str] = []
    article, silent = 0, ""
    skip, depth = "", 0  # the outermost furniture element that is open, and how often its name is
    hidden = 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                lines.append(Line(text, IN_FURNITURE if skip else IN_ARTICLE if article else PLAIN))

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text and not silent:
            parts.append(text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        closing, tag = bool(m[1]), m[2].lower()
        if silent:
            if tag == silent:
                hidden += -1 if closing else 1 if not m[0].endswith("/>") else 0
                if hidden <= 0:
                    silent = ""
            elif silent == "head" and tag == "body" and not closing:
                silent = ""
            elif tag in RAW and not closing:
                end = _RAW_END[tag].search(page, at)
                at = end.start() if end else len(page)
            if silent or tag in SILENT:
                continue
        if tag in BLOCKS:
            flush()
        if closing:
            if tag == skip:
                depth -= 1
                if not depth:
                    flush()
                    skip = ""
            elif tag in ARTICLE and article:
                if not skip or skip in ("header", "footer", "nav", "aside", "form"):
                    flush()
                    skip, depth, article = "", 0, article - 1
            continue
        if tag in SILENT:
            if not m[0].endswith("/>"):
                silent, hidden = tag, 1
                if tag in RAW:
                    end = _RAW_END[tag].search(page, at)
                    at = end.start() if end else len(page)
            continue
        if tag in VOID or m[0].endswith("/>"):
            continue
        if skip:
            if tag == skip:
                depth += 1
            elif tag in ARTICLE and not article and not _is_named(m[3]):  # furniture that was never closed ends where the article begins
                flush()
                skip, depth, article = "", 0, article + 1
            continue
        if tag in ARTICLE and not _is_named(m[3]):
            flush()
            article += 1
        elif tag != "body" and tag != "html" and (tag in FURNITURE or _is_named(m[3])):
            flush()
            skip, depth = tag, 1
            if tag in RAW:
                end = _RAW_END[tag].search(page, at)
                at = end.start() if end else len(page)
    flush()
    return lines


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case without port and user, and path."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path
    except ValueError:
        return "", url or ""


_ROWS = 1 << 28


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Rows of the alignment are integers with a bit for each place of ``b``; a pair of pages whose rows would take too much memory
    is cut in halves first.
    """
    common = set(a) & set(b)
    at_a, b = [i for i, x in enumerate(a) if x in common], [x for x in b if x in common]
    return [at_a[i] for i in _subsequence([a[i] for i in at_a], b)]


def _bits(b: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for j, x in enumerate(b):
        out[x] = out.get(x, 0) | (1 << j)
    return out


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    full, masks = (1 << len(b)) - 1, _bits(b)
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
    found = np.unpackbits(np.frombuffer((~v & full).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(found)))


def _subsequence(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > _ROWS:
        mid = len(a) // 2
        cut = int(np.argmax(_lengths(a[:mid], b) + _lengths(a[mid:][::-1], b[::-1])[::-1]))
        return _subsequence(a[:mid], b[:cut]) + [mid + i for i in _subsequence(a[mid:], b[cut:])]
    full, masks = (1 << len(b)) - 1, _bits(b)
    v, rows = full, [full]
    for x in a:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    out, j = [], len(b)
    for i in range(len(a), 0, -1):
        if not j:
            break
        # place i - 1 is used if its row gains a step at or below j that the row before lacks, at the last such step
        gained = (rows[i - 1] & ~rows[i]) & ((1 << j) - 1)
        now = (~rows[i] & ((1 << j) - 1)).bit_count()
        before = (~rows[i - 1] & ((1 << j) - 1)).bit_count()
        if now > before and gained:
            mine = masks.get(a[i - 1], 0) & ((1 << j) - 1)
            while mine:
                k = mine.bit_length() - 1
                low = (1 << k) - 1
                if (~rows[i - 1] & low).bit_count() + 1 == now:
                    out.append(i - 1)
                    j = k
                    break
                mine &= low
    return out[::-1]


def main_text(lines: list[Line], partner: list[int] | None, own: list[int]) -> str:
    """The text of a page from its lines, their hashes and those of its partner."""
    named = any(x.zone == IN_ARTICLE for x in lines)
    shared = set(common_subsequence(own, partner)) if partner else set(range(len(lines)) if named else ())
    return "\n".join(x.text for i, x in enumerate(lines) if x.zone == IN_ARTICLE or (x.zone == PLAIN and i not in shared))


def _hash_lines(lines: list[Line]) -> list[int]:
    import xxhash
    return [xxhash.xxh3_64_intdigest(x.text.encode("utf-8", "surrogatepass")) - (1 << 63) for x in lines]


#: What tells contents apart: two hashes over the host and the lines of a page.
_KEY = ["k1", "k2"]


def _key(host: str, hashes: list[int]) -> tuple[int, int]:
    import xxhash
    data = host.encode("utf-8", "surrogatepass") + b"\n" + np.array(hashes, np.int64).tobytes()
    return tuple(xxhash.xxh3_64_intdigest(data, seed) - (1 << 63) for seed in (1, 2))


def _pages(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    return pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(payload).cast("string").alias("html"))


def _hashed(pages: DataFrame) -> DataFrame:
    """``host, path`` and the line hashes of each different content of a host, at its first path."""
    def one(block):
        out = []
        for u, h in zip(block.column("url").to_pylist(), block.column("html").to_pylist(), strict=True):
            (host, path), hashes = split_url(u), _hash_lines(page_lines(h or ""))
            out.append((*_key(host, hashes), host, path, hashes))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()))
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[*_KEY, "host", "path", "hashes"])

    found = map_blocks(pages.select("url", "html"), "html", one, "k1 bigint, k2 bigint, host string, path string, hashes array<bigint>")
    return found.groupBy(*_KEY).agg(F.first("host").alias("host"), F.min("path").alias("path"), F.first("hashes").alias("hashes"))


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


#: A page that holds this share of another's lines is a copy of it, and tells nothing about what is furniture there.
COPY = 0.95


def _is_copy(own: list[int], other: list[int]) -> bool:
    lines = set(own)
    return len(lines & set(other)) >= COPY * len(lines)


def _nearer(path: str, own: list[int], back: tuple | None, after: tuple | None) -> list[int] | None:
    """Line hashes of the neighbour (path, hashes) with the longer common path that is no copy; of equally near ones that before."""
    back, after = (x if x is not None and not _is_copy(own, x[1]) else None for x in (back, after))
    if back is None or (after is not None and _common(path, after[0]) > _common(path, back[0])):
        back = after
    return None if back is None else back[1]


_SORTED = pa.schema([
    ("part", pa.int32()), ("at", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("host", pa.string()), ("path", pa.string()),
    ("partner", pa.list_(pa.int64())), ("edge", pa.list_(pa.int64())), ("other_path", pa.string()), ("other", pa.list_(pa.int64()))])


def _sorted_neighbours(light: DataFrame) -> DataFrame:
    """Pages in the order of host and path with their partition and place in it, and their partner. The first and the last page
    of a partition also tell their own hashes (``edge``) and the neighbour they have inside (``other``)."""
    def run(batches):
        def rows():
            back, row, n = None, None, 0
            for batch in batches:
                for new in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                    if row is not None:
                        yield n, row, back, new
                        back, n = row, n + 1
                    row = new
            if row is not None:
                yield n, row, back, None

        held = []
        for n, (part, k1, k2, host, path, hashes), back, after in rows():
            sides = [x[4:] if x is not None and x[3] == host else None for x in (back, after)]
            is_edge = back is None or after is None
            other = (sides[1] if back is None else sides[0]) if is_edge else None
            held.append((part, n, k1, k2, host, path, _nearer(path, hashes, *sides), hashes if is_edge else None, *(other or (None, None))))
            if len(held) == 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _SORTED, strict=True)], schema=_SORTED)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _SORTED, strict=True)], schema=_SORTED)

    order = ["host", "path", *_KEY]
    placed = light.repartitionByRange(*order).sortWithinPartitions(*order)
    return map_batches(placed.select(F.spark_partition_id().alias("part"), *_KEY, "host", "path", "hashes"), run,
                       "part int, at bigint, k1 bigint, k2 bigint, host string, path string, partner array<bigint>, edge array<bigint>, "
                       "other_path string, other array<bigint>")


def partners(light: DataFrame) -> DataFrame:
    """``k1, k2, partner``: the line hashes of the nearest other page of the same host, null where neither neighbour is one or both are copies."""
    rows = pin(_sorted_neighbours(light))
    page = F.struct("host", "path", "edge")
    edges = rows.where("edge IS NOT NULL").groupBy("part").agg(
        F.min_by(page, "at").alias("first"), F.max_by(page, "at").alias("last"), F.max("at").alias("n"))
    w = W.orderBy("part")  # one row for each partition
    edges = edges.select("part", "n", F.lag("last").over(w).alias("before"), F.lead("first").over(w).alias("after"))

    def run(batches):
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                inside = (r["other_path"], r["other"]) if r["other"] is not None else None
                beyond = [(e["path"], e["edge"]) if e is not None and e["host"] == r["host"] else None for e in (r["before"], r["after"])]
                back = beyond[0] if r["at"] == 0 else inside
                after = beyond[1] if r["at"] == r["n"] else inside
                found.append(_nearer(r["path"], r["edge"], back, after))
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(found, pa.list_(pa.int64()))],
                                             names=[*_KEY, "partner"])

    outer = rows.where("edge IS NOT NULL").join(edges, "part")  # two rows for each partition
    return rows.where("edge IS NULL").select(*_KEY, "partner").unionByName(
        map_batches(outer, run, "k1 bigint, k2 bigint, partner array<bigint>"))


def _pack(lines: list[Line]) -> bytes:
    """Lines hold no line breaks, so they travel as one compressed text after their zones."""
    return zlib.compress(bytes(x.zone for x in lines) + b"\n" + "\n".join(x.text for x in lines).encode("utf-8", "surrogatepass"), 3)


def _unpack(packed: bytes) -> list[Line]:
    zones, _, text = zlib.decompress(packed).partition(b"\n")
    return [Line(t, z) for t, z in zip(text.decode("utf-8", "surrogatepass").split("\n"), zones, strict=False)]


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``page_id, url, text`` and ``n_chars`` (code points) of each page."""
    source = _pages(pages, page_id, url, payload)
    found = pin(partners(_hashed(source)))

    def parse(block):
        packed, keys = [], []
        for u, h in zip(block.column("url").to_pylist(), block.column("html").to_pylist(), strict=True):
            lines = page_lines(h or "")
            packed.append(_pack(lines))
            keys.append(_key(split_url(u)[0], _hash_lines(lines)))
        columns = [pa.array(c, pa.int64()) for c in zip(*keys, strict=True)]
        return pa.RecordBatch.from_arrays([block.column("page_id"), block.column("url"), *columns, pa.array(packed, pa.binary())],
                                          names=["page_id", "url", *_KEY, "packed"])

    parsed = map_blocks(source, "html", parse, "page_id bigint, url string, k1 bigint, k2 bigint, packed binary")
    joined = parsed.join(found, _KEY, "left").select("page_id", "url", "packed", "partner")

    def run(batches):
        for batch in batches:
            texts = []
            for packed, partner in zip(batch.column("packed").to_pylist(), batch.column("partner").to_pylist(), strict=True):
                lines = _unpack(packed)
                texts.append(main_text(lines, partner, _hash_lines(lines)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return map_batches(joined, run, "page_id bigint, url string, text string, n_chars bigint")
