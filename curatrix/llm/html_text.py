"""Main text of web pages: markup first, then a suffix array for each host.

Pages are cut into blocks of visible text.  A block is the article's (inside
``article`` or ``main``), boilerplate by its markup, or open; a name such as
``share-price`` that holds a word of the usual names for boilerplate is only a
hint.  The words of all blocks are concatenated for each host, page after page,
and suffix arrays over them find the runs that several pages share, on every host
and in all blocks.  They decide wherever markup does not: hinted blocks go if most
of their words lie in such runs, and pages without an article keep the uncovered
runs of their open blocks.  Other words of an article are never removed: articles
do quote the same passages.

The words of a host need not fit a task.  Each run has an anchor, a short sequence
of its words, and only the contexts of anchors that enough pages of the host share
are sent to its arrays; a run is whole in the contexts of its anchor, and all pages
that have it meet in one array.  What the arrays found goes back to the chunks of
pages that have these contexts, so texts are not shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import joined, steps
from .common import child_uri, materialise, open_store, shared_dir, small_batches

ARTICLE, OPEN, BOILERPLATE, HINTED_ARTICLE, HINTED_OPEN = range(5)
#: A repeated run has at least so many words and is on at least so many pages.
RUN_WORDS, RUN_PAGES = 8, 3
#: Words of an anchor, by which runs are brought together.
ANCHOR_WORDS = 4
#: A host has a suffix array for so many distinct pages.
SHARD_PAGES = 500
#: So many hosts of several arrays are broadcast at most.
BROADCAST_HOSTS = 20_000
#: Characters of text in a chunk of pages, words whose anchors are in a bucket.
CHUNK_BYTES, BUCKET_WORDS = 16 << 20, 2_000_000
#: A worker holds so many contexts at most.
MOST_CONTEXTS = 100_000
#: Base of the words' polynomials.
BASE = 0x9E3779B97F4A7C15

#: Attributes up to the end of a tag; possessive, so that what does not end costs one pass.
_TAIL = re.compile(r"""(?:[^\s=>/"'][^\s=>/]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+|[\s/="'])*+>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)(?=[\s=/>]|$)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""", re.I)
_PARTS = re.compile(r"[_-]+|(?<=[a-z])(?=[A-Z])")
#: Elements whose content is no markup; the last three hold none of the page's text and go on to the end of a page if they are never closed.
_RAW = {"textarea", "title", "iframe", "noembed", "noframes", "xmp", "script", "style"}
_CODE = {"script", "style"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_AWAY = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "select", "head"}
#: Those of them, and the header, that may hold articles of their own, such as teasers.
_SECTIONS = {"nav", "footer", "aside", "menu", "header"}
#: Left out as a whole where they are closed; an unclosed one is passed over.
_CLOSED_ONLY = {"svg", "math", "object", "template", "noscript", "canvas", "audio", "video"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header",
    "commentlist", "commentform", "masthead", "menu", "modal", "nav", "navbar", "navigation", "topnav", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "recommended", "related", "replies", "share",
    "sharing", "sidebar", "sidenav", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Inside an article, a name on one of these elements only hints at boilerplate; lists whose text is mostly links go.
_WORDING = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "table", "tr", "td", "th", "figure", "figcaption", "li", "dd", "dt"}
_LISTS = {"ul", "ol", "dl"}
#: Words that add nothing to a name.
_PLAIN = {"area", "bar", "block", "bottom", "box", "buttons", "col", "column", "container", "content", "form", "global", "group", "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "page", "panel", "primary", "right", "row", "secondary", "section", "site", "slot", "top", "unit", "wrap", "wrapper"}


def _markup(name: str, attributes: str, in_article: bool) -> int:
    """What the markup says of an element: 3 no main text, 2 none by its name, 1 perhaps none, 0 nothing."""
    if name in _AWAY or name in _CLOSED_ONLY or name == "header" and not in_article:
        return 3
    if not attributes or name in ("html", "body", "main"):
        return 0
    found = 0
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in _ROLES:
            return 3
        for word in value.split() if key in ("class", "id") else ():
            parts = {p.lower() for p in _PARTS.split(word) if p and not p.isdigit()}
            told = parts & _NAMES - {"header", "masthead"} if in_article else parts & _NAMES
            if told:
                found = max(found, 2 if parts <= _NAMES | _PLAIN else 1)
    return found


def _tags(html: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """``(begin, end, name, attributes, closes)`` of every tag; comments and raw content are tags without a name.

    Every character is looked at a bounded number of times, whatever is left open.
    """
    at, size = 0, len(html)
    ends: dict[str, list[int]] = {}

    def closed_at(name: str, after: int) -> int:
        if name not in ends:
            ends[name] = [m.start() for m in re.finditer(f"</{re.escape(name)}(?=[\\s/>])", html, re.I)]
        k = bisect_left(ends[name], after)
        return ends[name][k] if k < len(ends[name]) else -1

    while (begin := html.find("<", at)) >= 0:
        after = html[begin + 1 : begin + 2]
        if after in ("!", "?"):
            mark = "-->" if html.startswith("<!--", begin) else ">"
            end = html.find(mark, begin + 2 if mark == ">" else begin + 4)
            at = end + len(mark) if end >= 0 else size
            yield begin, at, "", "", False
            continue
        closes = after == "/"
        found = _NAME.match(html, begin + 1 + closes)
        if found is None:
            at = begin + 1
            continue
        tail = _TAIL.match(html, found.end())
        if tail is None:
            # As in browsers, a tag that the page ends in is no text.
            yield begin, size, "", "", False
            return
        name, at = found[0].lower(), tail.end()
        if not closes and (name in _RAW or name in _CLOSED_ONLY):
            end = closed_at(name, at)
            if end < 0 and name not in _CODE:
                yield begin, at, "", "", False
                continue
            if name in _RAW:
                at = html.find(">", end) + 1 if end >= 0 else size
                yield begin, at or size, "", "", False
                at = at or size
                continue
        yield begin, at, name, html[found.end() : at - 1], closes


def _holders(tags: list[tuple[int, int, str, str, bool]]) -> tuple[set[int], list[int], bool]:
    """The numbers of tags whose element holds an article, for each tag how many elements it leaves open, and whether an article is plainly the page's.

    Elements such as ``nav`` count only if they are never closed.  An article is
    plainly the page's if no markup or name, its own or of what holds it, speaks
    against it.
    """
    stack: list[tuple[int, str]] = []
    against: list[bool] = []
    plain = False
    open_names: Counter[str] = Counter()
    holders: set[int] = set()
    closed: set[int] = set()
    depths: list[int] = []

    def cut(n: int) -> None:
        while len(stack) > n:
            against.pop()
            open_names[stack.pop()[1]] -= 1

    for k, (_, _, name, attributes, closes) in enumerate(tags):
        if closes:
            if open_names[name]:
                n = len(stack) - 1
                while stack[n][1] != name:
                    n -= 1
                if name in _SECTIONS:
                    closed.add(stack[n][0])
                cut(n)
        elif name and name not in _VOID and not attributes.endswith("/"):
            if name == "body":
                cut(0)
            # A paragraph ends where a block begins, an item where the next one does.
            for ends in ("p",) if name not in _INLINE else ():
                n = len(stack) - 1
                while open_names[ends] and n >= 0 and stack[n][1] in _INLINE:
                    n -= 1
                if n >= 0 and stack[n][1] == ends:
                    cut(n)
            if name in ("li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1][1] == name:
                cut(len(stack) - 1)
            bad = bool(against) and against[-1] or _markup(name, attributes, False) >= 2
            if name in ("article", "main"):
                plain = plain or not bad
                n = len(stack) - 1
                while n >= 0 and stack[n][0] not in holders:
                    holders.add(stack[n][0])
                    n -= 1
            stack.append((k, name))
            against.append(bad)
            open_names[name] += 1
            depths.append(len(stack) - 1)
            continue
        depths.append(len(stack))
    return holders - closed, depths, plain


def _mostly_links(html: str, tags: list[tuple[int, int, str, str, bool]], depths: list[int], k: int) -> bool:
    """Whether over half of the text in the element of tag ``k`` is in links."""
    sizes, link, at = [0, 0], False, tags[k][1]
    for j in range(k + 1, len(tags)):
        begin, end, name, _, closes = tags[j]
        sizes[link] += len(html[at:begin].strip())
        if depths[j] < depths[k] or closes and depths[j] == depths[k]:
            break
        link, at = not closes if name == "a" else link, end
    return sizes[1] > sizes[0]


def blocks(html: str) -> list[tuple[int, str]]:
    """``(kind, text)`` of every block with text, in page order, white space made single spaces."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    kinds: list[int] = []
    kind, at = OPEN, 0

    def end_block() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                out.append((kind, text))
            held.clear()

    tags = list(_tags(html))
    holders, depths, plain = _holders(tags)
    for k, ((begin, end, name, attributes, closes), depth) in enumerate(zip(tags, depths, strict=True)):
        if begin > at:
            held.append(html[at:begin])
        at = end
        if not name:
            continue
        if name not in _INLINE or name == "br":
            end_block()
        opens = not closes and name not in _VOID and not attributes.endswith("/")
        if len(kinds) > depth:
            if kinds[depth] != kind:
                end_block()
            kind = kinds[depth]
            del kinds[depth:]
        if not opens:
            continue
        inside = kind in (ARTICLE, HINTED_ARTICLE)
        told = 0 if kind == BOILERPLATE else _markup(name, attributes, inside)
        if not inside and (k in holders or name == "article"):
            # What holds an article goes by its markup only if another is the page's.
            told = told if plain and told >= 2 else 0
        elif inside and told == 2 and (name in _WORDING or name in _LISTS and not (kind == ARTICLE and _mostly_links(html, tags, depths, k))):
            told = 1
        if kind == BOILERPLATE or told >= 2:
            inner = BOILERPLATE
        elif told == 1:
            inner = HINTED_ARTICLE if inside else HINTED_OPEN
        elif not inside and name in ("article", "main"):
            inner = ARTICLE
        else:
            inner = kind
        if inner != kind:
            end_block()
        kinds.append(kind)
        kind = inner
    held.append(html[at:])
    end_block()
    return out


def _cover(starts: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a run of ``size`` words that begins at one of the marked ones."""
    sums = np.concatenate([np.zeros(size, np.int64), np.cumsum(starts)])
    return sums[size:] > sums[:-size]


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in ascending order, by prefix doubling."""
    n, known = len(ids), 1
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    while n and known < n and rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[: n - known] = rank[known:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        known *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def repeated_starts(ids: np.ndarray, pages: np.ndarray, least_words: int = RUN_WORDS, least_pages: int = RUN_PAGES) -> np.ndarray:
    """Which words begin a run of ``least_words`` that is on ``least_pages`` pages or more.

    ``ids`` are the concatenated word ids, with an id of its own at the end of
    each page.  Neighbours in the order of the suffixes that begin with the
    same ``least_words`` words are starts of one run.
    """
    n = len(ids)
    out = np.zeros(n, bool)
    if n < least_words:
        return out
    order = suffix_order(ids)
    order = order[order <= n - least_words]
    same = np.ones(len(order) - 1, bool)
    for k in range(least_words):
        same &= ids[order[1:] + k] == ids[order[:-1] + k]
    run = np.cumsum(np.concatenate([[False], ~same]))
    met = np.unique(np.stack([run, pages[order]], 1), axis=0)[:, 0]
    out[order[np.bincount(met, minlength=run[-1] + 1)[run] >= least_pages]] = True
    return out


def _kept(page: list[tuple[int, str]], starts: np.ndarray) -> str:
    """A page's text, given which of the words of all its blocks begin a repeated run.

    Runs go on over the ends of blocks, so that rows of short blocks are found;
    such a run takes whole blocks only, so that the next block keeps its first words.
    """
    has_article = any(k in (ARTICLE, HINTED_ARTICLE) for k, _ in page)
    across = _cover(starts, RUN_WORDS)
    kept, at = [], 0
    for kind, text in page:
        size = text.count(" ") + 1
        whole, within = across[at : at + size], starts[at : at + size]
        at += size
        if kind == BOILERPLATE or kind in (OPEN, HINTED_OPEN) and has_article:
            continue
        if kind == ARTICLE:
            kept.append(text)
            continue
        within = within.copy()
        within[max(0, size - RUN_WORDS + 1) :] = False
        away = whole if whole.all() else _cover(within, RUN_WORDS)
        if kind in (HINTED_ARTICLE, HINTED_OPEN) and 2 * int(away.sum()) >= size:
            continue
        kept += [text] if kind == HINTED_ARTICLE else [w for w, c in zip(text.split(" "), away, strict=True) if not c]
    return " ".join(kept)


def host_texts(pages: list[list[tuple[int, str]]], numbers: list[int] | None = None) -> list[str]:
    """Main texts of one host's pages; those of equal numbers (by default: equal blocks) count as one page."""
    if numbers is None:
        known: dict[tuple[tuple[int, str], ...], int] = {}
        numbers = [known.setdefault(tuple(page), len(known)) for page in pages]
    names: dict[str, int] = {}
    ids: list[int] = []
    owners: list[int] = []
    places: list[tuple[int, int]] = []
    for number, page in zip(numbers, pages, strict=True):
        own = [names.setdefault(w, len(names)) for _, text in page for w in text.split(" ")]
        places.append((len(ids), len(ids) + len(own)))
        ids += own
        ids.append(-len(ids) - 1)
        owners += [number] * (len(own) + 1)
    starts = repeated_starts(np.array(ids, np.int64), np.array(owners, np.int64))
    return [_kept(page, starts[a:b]) for page, (a, b) in zip(pages, places, strict=True)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(ids: np.ndarray, sizes: np.ndarray, hosts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of pages of hosts: where they begin in the words of all pages, ascending, and their hashes.

    The anchor of a run of ``RUN_WORDS`` words is the first of its sequences of
    ``ANCHOR_WORDS`` words that have the least hash, so equal runs of a host have
    equal anchors at the same place.
    """
    n, spread = len(ids), RUN_WORDS - ANCHOR_WORDS + 1
    if n < RUN_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    page = np.repeat(np.arange(len(sizes)), sizes)
    grams = np.zeros(n - ANCHOR_WORDS + 1, np.uint64)
    for k in range(ANCHOR_WORDS):
        grams = grams * np.uint64(BASE) + ids[k : k + len(grams)]
    grams = _mixed(grams ^ hosts.view(np.uint64)[page[: len(grams)]])
    runs = n - RUN_WORDS + 1
    least = grams[:runs]
    for k in range(1, spread):
        least = np.minimum(least, grams[k : k + runs])
    at = np.arange(runs)
    for k in reversed(range(spread)):
        at = np.where(grams[k : k + runs] == least, np.arange(k, k + runs), at)
    at = at[page[:runs] == page[RUN_WORDS - 1 :]]
    # They ascend from run to run.
    at = at[np.diff(at, prepend=-1) > 0]
    return at, _mixed(grams[at] + np.uint64(1))


def _codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Hashes as the number of a bucket and 32 bits."""
    return hashes % np.uint64(buckets) << np.uint64(32) | hashes >> np.uint64(32)


def _parsed(rows: DataFrame) -> DataFrame:
    """``(page_id, url, host, content, chunk, place, n_words, kinds, blocks)`` of every page ``(page_id, url, host, html)``.

    ``content`` is a hash of all blocks; ``chunk`` numbers pages of about
    ``CHUNK_BYTES`` that are written one after the other, ``place`` those of a chunk.
    """
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.int64()), ("content", pa.int64()), ("chunk", pa.int64()), ("place", pa.int64()), ("n_words", pa.int64()), ("kinds", pa.list_(pa.int8())), ("blocks", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        chunk, place, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            for part in steps(batch, 3):
                if size > CHUNK_BYTES:
                    chunk, place, size = chunk + 1, 0, 0
                pages = [blocks(html) for html in part.column(3).to_pylist()]
                contents = np.array([xxh64_intdigest("\n".join(f"{k} {t}" for k, t in page).encode("utf-8", "surrogatepass")) for page in pages], np.uint64)
                n_words = pa.array([sum(t.count(" ") + 1 for _, t in page) for page in pages], pa.int64())
                columns = [pa.array(contents.view(np.int64)), pa.array(np.full(len(pages), chunk)), pa.array(np.arange(place, place + len(pages))), n_words, pa.array([[k for k, _ in page] for page in pages], pa.list_(pa.int8())), pa.array([[t for _, t in page] for page in pages], pa.list_(pa.string()))]
                place += len(pages)
                size += sum(len(t) for page in pages for _, t in page)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], schema=kind)

    return rows.mapInArrow(run, "page_id bigint, url string, host bigint, content bigint, chunk bigint, place bigint, n_words bigint, kinds array<tinyint>, blocks array<string>")


def _for_chunks(df: DataFrame, name: str) -> str:
    """Write ``df`` in a folder for each chunk; returns the URI."""
    path = shared_dir(df.sparkSession, name)
    df.repartition("chunk").write.partitionBy("chunk").parquet(path)
    return path


def _of_chunk(uri: str, chunk: int) -> Iterator[pa.Table]:
    """What is written for a chunk."""
    from pyarrow import fs, parquet

    store, path = open_store(child_uri(uri, f"chunk={chunk}"))
    for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if info.is_file and info.base_name.endswith(".parquet"):
            with store.open_input_file(info.path) as file:
                yield parquet.ParquetFile(file).read()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Rows with a column ``chunk`` by chunk, in slices of at most 256 rows."""

    def slices() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for at in range(a, b, 256):
                    yield int(numbers[at]), batch.slice(at, min(256, b - at))

    for chunk, group in groupby(slices(), lambda x: x[0]):
        yield chunk, (part for _, part in group)


def word_ids(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words of some bytes: polynomials modulo 2^64, of about a million bytes at once."""
    out = np.zeros(len(starts), np.uint64)
    powers = inverses = np.ones(1, np.uint64)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 20), side="right")))
        first, last = int(starts[at]), int(ends[end - 1])
        if len(powers) <= last - first:
            powers, inverses = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(last - first, base, np.uint64)])) for base in (BASE, pow(BASE, -1, 1 << 64)))
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum((raw[first:last].astype(np.uint64) + np.uint64(1)) * powers[: last - first], out=sums[1:])
        begins = starts[at:end] - first
        out[at:end] = (sums[ends[at:end] - first] - sums[begins]) * inverses[begins]
        at = end
    return out


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(raw, starts, ends, sizes)`` of pages: the bytes of all blocks, where each word begins and ends, and how many each page has; no text is one empty word."""
    raw, bounds = joined(pc.binary_join(part.column("blocks"), " "))
    spaces = np.flatnonzero(raw == 32)
    starts = np.sort(np.concatenate([bounds[:-1], spaces + 1]), kind="stable")
    ends = np.sort(np.concatenate([spaces, bounds[1:]]), kind="stable")
    return raw, starts, ends, np.diff(np.searchsorted(spaces, bounds)) + 1


def _owners(uri: str, chunk: int) -> dict[int, int | None]:
    """The pages of a chunk that are copies, by place, with the id they count as."""
    return {p: o for t in _of_chunk(uri, chunk) for p, o in zip(t["place"].to_pylist(), t["owner"].to_pylist(), strict=True)}


def _known(uri: str, chunk: int) -> np.ndarray:
    """The codes of a chunk's anchors that are on enough pages, ascending."""
    found = [np.frombuffer(c, np.uint32).astype(np.uint64) | np.uint64(b << 32) for t in _of_chunk(uri, chunk) for b, c in zip(t["bucket"].to_pylist(), t["codes"].to_pylist(), strict=True)]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _shared_anchors(parsed: DataFrame, copies: str, buckets: int) -> DataFrame:
    """``(chunk, bucket, codes)``: of each chunk's anchors those that are on ``RUN_PAGES`` contents of a host or more.

    Anchors go as 32 bits and a bucket; those that are taken for others are told
    apart in the arrays.
    """
    sent = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("counted", pa.binary()), ("asked", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, parts in _chunks(batches):
            away = np.array(list(_owners(copies, chunk)), np.int64)
            counted, asked = [], []
            for part in parts:
                *words, sizes = _words(part)
                at, hashes = anchors(word_ids(*words), sizes, part.column("host").to_numpy())
                page = np.searchsorted(np.cumsum(sizes), at, side="right")
                codes = _codes(hashes, buckets)
                order = np.lexsort((codes, page))
                page, codes = page[order], codes[order]
                first = np.ones(len(codes), bool)
                first[1:] = (codes[1:] != codes[:-1]) | (page[1:] != page[:-1])
                copy = np.isin(part.column("place").to_numpy(), away)[page[first]]
                counted.append(codes[first][~copy])
                asked.append(codes[first][copy])
            parcels = [np.sort(np.concatenate(counted)), np.unique(np.concatenate(asked))]
            bounds = [np.searchsorted(c, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)) for c in parcels]
            filled = [b for b in range(buckets) if any(e[b] < e[b + 1] for e in bounds)]
            columns = [pa.array([c[e[b] : e[b + 1]].astype(np.uint32).tobytes() for b in filled], pa.binary()) for c, e in zip(parcels, bounds, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array([chunk] * len(filled), pa.int64()), *columns], schema=sent)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for bucket, group in groupby(rows, lambda r: r[0]):
            held = [(chunk, np.frombuffer(c, np.uint32), np.frombuffer(a, np.uint32)) for _, chunk, c, a in group]
            every = np.sort(np.concatenate([c for _, c, _ in held]))
            # A code is met so often if it stands as many places on, too.
            many = np.unique(every[RUN_PAGES - 1 :][every[RUN_PAGES - 1 :] == every[: max(0, len(every) - RUN_PAGES + 1)]])
            for chunk, counted, asked in held:
                found = np.intersect1d(np.union1d(counted, asked), many, assume_unique=True)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()), pa.array([found.tobytes()], pa.binary())], ["chunk", "bucket", "codes"])

    asked = parsed.select("host", "chunk", "place", "blocks").mapInArrow(ask, "bucket int, chunk bigint, counted binary, asked binary")
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, "chunk bigint, bucket int, codes binary")


def _contexts(parsed: DataFrame, copies: str, known: str, buckets: int) -> DataFrame:
    """``(chunk, host, anchor, context, owners)``: the words around each chunk's shared anchors, with up to ``RUN_PAGES`` pages that have them.

    A context holds every run whose anchor it is cut around.
    """
    kind = pa.schema([("chunk", pa.int64()), ("host", pa.int64()), ("anchor", pa.int64()), ("context", pa.binary()), ("owners", pa.list_(pa.string()))])

    def rows(chunk: int, held: dict[tuple[int, int, bytes], set[str]]) -> Iterator[pa.RecordBatch]:
        keys, owners = list(held), list(held.values())
        for at in range(0, len(keys), 4096):
            some = keys[at : at + 4096]
            columns = [pa.array([k[c] for k in some], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(some), pa.int64()), *columns, pa.array([list(o) for o in owners[at : at + 4096]], pa.list_(pa.string()))], schema=kind)
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, parts in _chunks(batches):
            away, codes = _owners(copies, chunk), _known(known, chunk)
            held: dict[tuple[int, int, bytes], set[str]] = {}
            for part in parts if len(codes) else ():
                hosts, contents = part.column("host").to_pylist(), part.column("content").to_pylist()
                # A row without id counts by its content.
                owners = [away.get(p, i) for p, i in zip(part.column("place").to_pylist(), part.column("page_id").to_pylist(), strict=True)]
                owners = [f"c{c}" if o is None else f"p{o}" for o, c in zip(owners, contents, strict=True)]
                for page, anchor, _, context in _cut(part, codes, buckets):
                    pages = held.setdefault((hosts[page], anchor, context), set())
                    if len(pages) < RUN_PAGES:
                        pages.add(owners[page])
                if len(held) > MOST_CONTEXTS:
                    yield from rows(chunk, held)
            yield from rows(chunk, held)

    return parsed.select("page_id", "host", "content", "chunk", "place", "blocks").mapInArrow(run, "chunk bigint, host bigint, anchor bigint, context binary, owners array<string>")


def _cut(part: pa.RecordBatch, codes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
    """``(page, anchor, begin, context)`` of the anchors with one of the codes; ``begin`` counts the page's words."""
    raw, starts, stops, sizes = _words(part)
    at, hashes = anchors(word_ids(raw, starts, stops), sizes, part.column("host").to_numpy())
    asked = _codes(hashes, buckets)
    wanted = codes[np.minimum(np.searchsorted(codes, asked), len(codes) - 1)] == asked
    at, hashes = at[wanted], hashes[wanted]
    ends = np.cumsum(sizes)
    page = np.searchsorted(ends, at, side="right")
    firsts = np.concatenate([[0], ends])[page]
    begins = np.maximum(firsts, at - RUN_WORDS + ANCHOR_WORDS)
    lasts = np.minimum(ends[page], at + RUN_WORDS) - 1
    text = raw.tobytes()
    for number, anchor, begin, a, b in zip(page.tolist(), hashes.view(np.int64).tolist(), (begins - firsts).tolist(), starts[begins].tolist(), stops[lasts].tolist(), strict=True):
        yield number, anchor, begin, text[a:b]


def _digest(host: int, context: bytes) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(context, host & (1 << 64) - 1)


def _repeated(contexts: DataFrame) -> DataFrame:
    """``(chunk, context, starts)``: the digests of contexts with words that begin a repeated run, and those words as bits.

    The contexts of a host and shard ``(chunk, host, shard, context, owners)``
    have one suffix array, in which neighbours tell the runs.
    """
    kind = pa.schema([("chunk", pa.int64()), ("context", pa.binary()), ("starts", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for (host, _), group in groupby(rows, lambda r: (r[1], r[2])):
            pages: dict[bytes, set[str]] = {}
            chunks: dict[bytes, list[int]] = {}
            for chunk, _, _, context, owners in group:
                pages.setdefault(context, set()).update(owners)
                chunks.setdefault(context, []).append(chunk)
            starts = repeated_in_contexts(pages)
            found = [(chunk, _digest(host, context), s) for context, s in starts.items() for chunk in chunks[context]]
            for at in range(0, len(found), 4096):
                some = list(zip(*found[at : at + 4096], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(some, kind.types, strict=True)], schema=kind)

    chosen = contexts.select("chunk", "host", "shard", "context", "owners")
    return chosen.repartition("host", "shard").sortWithinPartitions("host", "shard").mapInArrow(run, "chunk bigint, context binary, starts bigint")


def repeated_in_contexts(pages: dict[bytes, set[str]]) -> dict[bytes, int]:
    """The contexts in which repeated runs begin, with the words at which they do as bits; ``pages`` has the pages of each."""
    names: dict[bytes, int] = {}
    numbers: dict[str, int] = {}
    ids: list[int] = []
    owners: list[int] = []
    places: list[int] = []
    for context, some in pages.items():
        own = [names.setdefault(w, len(names)) for w in context.split(b" ")]
        places.append(len(ids))
        # So many pages of one context are enough to tell its runs.
        for page in sorted(some)[:RUN_PAGES]:
            ids += own
            ids.append(-len(ids) - 1)
            owners += [numbers.setdefault(page, len(numbers))] * (len(own) + 1)
    starts = repeated_starts(np.array(ids, np.int64), np.array(owners, np.int64))
    out = {}
    for context, at in zip(pages, places, strict=True):
        size = context.count(b" ") + 1
        if bits := sum(1 << k for k in np.flatnonzero(starts[at : at + size]).tolist()):
            out[context] = bits
    return out


def _texts(parsed: DataFrame, known: str, repeated: str, buckets: int) -> DataFrame:
    """``(page_id, url, text, n_repeated)`` of every page."""
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_repeated", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, parts in _chunks(batches):
            bits: dict[bytes, int] = {}
            for table in _of_chunk(repeated, chunk):
                for context, starts in zip(table["context"].to_pylist(), table["starts"].to_pylist(), strict=True):
                    bits[context] = bits.get(context, 0) | starts
            codes = _known(known, chunk) if bits else np.zeros(0, np.uint64)
            for part in parts:
                hosts, sizes = part.column("host").to_pylist(), part.column("n_words").to_pylist()
                starts = [np.zeros(n, bool) for n in sizes]
                for page, _, begin, context in _cut(part, codes, buckets) if bits else ():
                    found = bits.get(_digest(hosts[page], context), 0)
                    for k in range(found.bit_length()):
                        if found >> k & 1:
                            starts[page][begin + k] = True
                pages = [list(zip(k, b, strict=True)) for k, b in zip(part.column("kinds").to_pylist(), part.column("blocks").to_pylist(), strict=True)]
                texts = [_kept(page, s) for page, s in zip(pages, starts, strict=True)]
                counts = [int(_cover(s, RUN_WORDS).sum()) for s in starts]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], schema=kind)

    return parsed.select("page_id", "url", "host", "chunk", "n_words", "kinds", "blocks").mapInArrow(run, "page_id bigint, url string, text string, n_repeated bigint")


def _few(hosts: DataFrame) -> DataFrame:
    """The hosts and their shards, to be broadcast if they are few."""
    listed = hosts.limit(BROADCAST_HOSTS + 1).collect()
    if len(listed) <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts.sparkSession.createDataFrame(listed, "host bigint, shards bigint"))
    return hosts


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_repeated)`` of every page; ``n_repeated`` counts its words, dropped or kept, in repeated runs.

    Null and empty html give an empty text; a null url is a host of its own;
    an empty table gives no rows.  Pages of equal content on a host count as one,
    that of their smallest id, and get the same text; so neither copies nor
    repeated rows of an id make words repeated.  The contexts of a host of up to
    ``SHARD_PAGES`` distinct pages have one suffix array, those of larger hosts
    are dealt to several by their anchors, with the same results.
    """
    host = F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    rows = small_batches(df).select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.xxhash64(host).alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    parsed = materialise(_parsed(rows), "parsed", "zstd")
    # Shorter pages have no run.
    pages = parsed.where(F.col("n_words") >= RUN_WORDS).select("page_id", "host", "content", "chunk", "place", "n_words")
    contents = pages.groupBy("host", "content").agg(F.min(F.struct(F.isnull("page_id"), "page_id", "chunk", "place")).alias("first"), F.count("*").alias("rows"), F.max("n_words").alias("n_words"))
    contents = materialise(contents, "contents")
    again = contents.where("rows > 1").select("host", "content", "first")
    again = pages.join(again, ["host", "content"]).where("(chunk, place) != (first.chunk, first.place)")
    copies = _for_chunks(again.select("chunk", "place", F.col("first.page_id").alias("owner")), "copies")
    words = contents.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(16, words // BUCKET_WORDS)
    known = _for_chunks(_shared_anchors(parsed, copies, buckets), "known")
    shards = contents.groupBy("host").agg(F.ceil(F.count("*") / SHARD_PAGES).alias("shards")).where("shards > 1")
    contexts = _contexts(parsed, copies, known, buckets).join(_few(shards), "host", "left")
    repeated = _for_chunks(_repeated(contexts.withColumn("shard", F.pmod("anchor", F.coalesce("shards", F.lit(1))))), "repeated")
    out = _texts(parsed, known, repeated, buckets)
    return out.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", "n_repeated")
