"""Main text of web pages by a suffix array over the pages of a host.

Pages are cut into text blocks, each in one of four zones: the article, the main element around it, boilerplate by its
markup, or open.
The token streams of what stands outside the article are concatenated for the pages of a host; in the
suffix array of that string, equal beginnings of RUN tokens stand together, and those that come from
distinct pages mark repeated runs. Open blocks that such runs cover are boilerplate; unique ones stay.
The pages of a large host are dealt into groups with a suffix array each; hashes of all runs of RUN tokens,
counted by host, tell every group what the others share with it. A block of fewer tokens goes if most pages of the host have it as a whole.
Pages of equal blocks are copies and count as one, however a host is dealt.
This holds on pages with an article too: a story or heading may stand beside it. Blocks of a main element go only if
most pages of the host have them and they are the lesser part of it, as notices are. Passages inside an explicit
article are protected: articles quote each other.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, tidy

#: Tokens of a repeated run; share of a block's tokens that repeated runs must cover to remove it.
RUN, COVERED = 8, 0.8
#: Pages of a host that share a suffix array; a host with more is dealt into several, joined by counts of hashed runs.
PAGES = 64
#: Up to so many hot hosts are broadcast (a name and a number each), more are joined by shuffle.
BROADCAST_HOSTS = 100_000

#: A notice in main elements, or a short block, stands on so many pages of a host at least, and on so great a share of them.
NOTICE_PAGES, NOTICE_SHARE = 3, 0.5

ARTICLE, OPEN, BOILERPLATE, MAIN = 0, 1, 2, 3

#: Comment, CDATA (1), declaration, tag with its quotes closed (2-4) or not (5-7), text (8), or a lone <. Each fails in one pass.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|([^<]+)|<",
    re.S,
)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Start tags that end an open element of the second column, if one is open inside the third.
_IMPLIED = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr",)), "th": ("td th", ("tr",)), "option": ("option", ("select",))}
_SKIPPED = frozenset("nav aside form footer script style noscript template svg iframe button select textarea dialog head title menu canvas audio video object datalist input".split())
#: Words of class, id or role names that mark boilerplate anywhere, and those that do outside an article only.
_SIGNS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus gdpr login menu menubar modal "
    "nav navbar navigation newsletter notice notices pagination paywall popup promo promoted promotion recommended related replies respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget widgets complementary contentinfo".split()
)
#: Words that say which part of a thing an element is, and not what it is about.
_PARTS = frozenset(
    "area articles bar block body bottom box btn button buttons cell center col column container content desktop fixed footer form frame full grid group head header icon icons id inline inner item items js label "
    "large left link links list main mobile module outer overlay page panel pane post posts primary right row secondary section site slot small sticky tab text title top unit view wrap wrapper".split()
)
_OUTER_SIGNS = _SIGNS | {"header", "footer", "masthead", "topbar", "bottom", "alert", "banner", "legal", "copyright"}


def _names(value: str, signs: frozenset[str]) -> bool:
    """Does one of the names (class, id, role) say that the element is boilerplate? share-buttons does, market-share does not:
    a sign counts if all other words of its name are signs or tell a part."""
    for name in value.split():
        words = _NAME.findall(_CAMEL.sub("-", name).lower())
        if not signs.isdisjoint(words) and all(w in signs or w in _PARTS or len(w) < 2 for w in words):
            return True
    return False


def _marked(attrs: str, signs: frozenset[str]) -> bool:
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                return True
        elif _names(value, signs):
            return True
    return False


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(zone, text) of the non-empty blocks in page order; white space is one space."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the zone outside of them
    zone, at, n = OPEN, 0, len(page)
    n_open: Counter[str] = Counter()
    last = page.rfind(">")

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((zone, text))

    def close(k: int) -> None:
        nonlocal zone
        if stack[k][1] != zone:
            flush()
        zone = stack[k][1]
        n_open.subtract(tag for tag, _ in stack[k:])
        del stack[k:]

    while at < n:
        if at > last:  # no tag can end any more, but a comment or the like may begin
            m = re.compile(r"<!--|<!\[CDATA\[|<[!?]").search(page, at)
            held.append(page[at : m.start() if m else n])
            if not m:
                break
            at = m.start()
        m = _TAG.match(page, at)
        at = m.end()
        if m[8]:
            held.append(m[8])
        elif m[1]:
            held.append(m[1].replace("&", "&amp;"))
        elif m[3] or m[6]:
            closing, tag, attrs = (m[2], m[3].lower(), m[4]) if m[3] else (m[5], m[6].lower(), m[7])
            if tag in _BLOCK:
                flush()
            elif tag == "br":
                held.append(" ")
            if closing:
                for k in range(len(stack) - 1, -1, -1) if n_open[tag] else ():
                    if stack[k][0] == tag:
                        close(k)
                        break
                continue
            if tag in _BLOCK and n_open["p"]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in _BLOCK:
                        break
            if tag in _IMPLIED:
                ends, within = _IMPLIED[tag]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ends.split():
                        close(k)
                        break
                    if stack[k][0] in within:
                        break
            if tag in _VOID or attrs.endswith("/") and tag not in _BLOCK:
                continue
            inner = zone
            if zone != BOILERPLATE:
                if tag in _SKIPPED or tag == "header" and zone not in (ARTICLE, MAIN) or attrs and _marked(attrs, _SIGNS if zone in (ARTICLE, MAIN) else _OUTER_SIGNS) and tag not in ("body", "html"):
                    inner = BOILERPLATE
                elif tag == "article":
                    inner = ARTICLE
                elif tag == "main" and zone == OPEN:
                    inner = MAIN
            if inner != zone:
                flush()
            stack.append((tag, zone))
            n_open[tag] += 1
            zone = inner
            if tag in _RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
                at = end.start() if end else n
        elif m[0] == "<":
            held.append("<")
    flush()
    return out


def page_counts(streams: list[list[str]], contents: list[int] | None = None) -> list[np.ndarray]:
    """For each page's tokens: how many pages have the run of RUN tokens that begins there (1 where none does). Pages of equal contents,
    which are copies as wholes, are one page."""
    if contents is not None and len(set(contents)) < len(contents):
        first = {c: k for k, c in reversed(list(enumerate(contents)))}
        own = sorted(first.values())
        counts = dict(zip(own, page_counts([streams[k] for k in own])))
        return [counts[first[c]] for c in contents]
    total = sum(map(len, streams))
    if total < 2 * RUN:
        return [np.ones(len(s), np.int64) for s in streams]
    numbers: dict[str, int] = {}
    text = np.empty(total + len(streams), np.int64)
    page = np.empty(len(text), np.int64)
    at, starts = 0, []
    for k, s in enumerate(streams):
        starts.append(at)
        text[at : at + len(s)] = [numbers.setdefault(t, len(numbers)) for t in s]
        page[at : at + len(s) + 1] = k
        at += len(s) + 1
        text[at - 1] = -1 - k  # an end that equals no other
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while step < n and rank.max() < n - 1:  # prefix doubling
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        step *= 2
    same = np.ones(n - 1, bool)  # neighbours in the suffix array that share RUN tokens
    a, b = order[:-1], order[1:]
    for j in range(RUN):
        inside = (a + j < n) & (b + j < n)
        same &= inside
        same[inside] &= text[a[inside] + j] == text[b[inside] + j]
    group = np.concatenate(([0], np.cumsum(~same)))
    of = page[order]
    pairs = np.unique(group * len(streams) + of) // len(streams)
    counts = np.empty(n, np.int64)
    counts[order] = np.bincount(pairs)[group]
    return [counts[s : s + len(t)] for s, t in zip(starts, streams)]


def covered(counts: np.ndarray, least: int = 2) -> np.ndarray:
    """Which tokens lie in a run that at least so many pages have."""
    hits = np.flatnonzero(counts >= least)
    edge = np.zeros(len(counts) + RUN + 1, np.int64)
    edge[hits] += 1
    edge[hits + RUN] -= 1
    return np.cumsum(edge)[: len(counts)] > 0


def repeated(streams: list[list[str]]) -> list[np.ndarray]:
    """For each page's tokens: which lie in a run of RUN tokens that another page has too."""
    return [covered(c) for c in page_counts(streams)]


def run_hashes(host: str, tokens: list[str], known: dict[str, int]) -> np.ndarray:
    """A hash of the host and each run of RUN tokens, the same in every process; known holds hashes of tokens."""
    if len(tokens) < RUN:
        return np.empty(0, np.int64)
    if len(known) > 300_000:
        known.clear()
    for t in {host, *tokens} - known.keys():
        known[t] = int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    own = np.array([known[t] for t in tokens], np.uint64)
    n = len(own) - RUN + 1
    out = np.full(n, known[host], np.uint64)
    for j in range(RUN):
        out = (out ^ own[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


_BREAK = "\n"


def block_hash(host: str, text: str) -> int:
    """Of a short block as a whole, the same in every process."""
    return int.from_bytes(hashlib.blake2b(f"{host}{_BREAK}{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def short_blocks(blocks: list[tuple[int, str]]) -> set[str]:
    """The texts of blocks outside the article that have no run of RUN tokens."""
    return {text for zone, text in blocks if zone != ARTICLE and text.count(" ") < RUN - 1}


def outside(blocks: list[tuple[int, str]]) -> list[str]:
    """The tokens outside the article, with a break after each block."""
    tokens: list[str] = []
    for zone, text in blocks:
        if zone != ARTICLE:
            tokens += text.split(" ")
            tokens.append(_BREAK)
    return tokens


def content_hash(blocks: list[tuple[int, str]]) -> int:
    """Of a page's blocks, the same in every process."""
    h = hashlib.blake2b(digest_size=8)
    for zone, text in blocks:
        h.update(f"{zone}{text}{_BREAK}".encode("utf-8", "surrogatepass"))
    return int.from_bytes(h.digest(), "little", signed=True)


def main_texts(pages: list[list[tuple[int, str]]], elsewhere: dict[int, int] | None = None, n_pages: int | None = None, host: str = "") -> list[str]:
    """The main text of each page, given the blocks of pages of one host and, if these are not all, how many different pages of
    the host have each hashed run or short block, if two or more do, and how many there are."""
    streams = [outside(blocks) for blocks in pages]
    contents = [content_hash(blocks) for blocks in pages]
    counts = [c.copy() for c in page_counts(streams, contents)]
    if elsewhere:
        known: dict[str, int] = {}
        for own, tokens in zip(counts, streams):
            hashes = run_hashes(host, tokens, known).tolist()
            own[: len(hashes)] = np.maximum(own[: len(hashes)], [elsewhere.get(h, 1) for h in hashes])
    most = max(NOTICE_PAGES, math.ceil(NOTICE_SHARE * (n_pages or len(set(contents)))))
    having: dict[str, set[int]] = defaultdict(set)
    for blocks, content in zip(pages, contents):
        for text in short_blocks(blocks):
            having[text].add(content)
    frequent = {text for text, own in having.items() if max(len(own), (elsewhere or {}).get(block_hash(host, text), 1)) >= most}
    out = []
    for blocks, own in zip(pages, counts):
        hit, notice = covered(own), covered(own, most)
        kept, at, size, lost = [], 0, 0, 0  # size, lost: tokens of the article or main element, and of notices in it
        for zone, text in blocks:
            n = text.count(" ") + 1
            if zone == ARTICLE:
                kept.append((zone, text, True))
                size += n
                continue
            unique = (notice if zone == MAIN else hit)[at : at + n].sum() < COVERED * n and text not in frequent
            at += n + 1
            if zone != BOILERPLATE:
                kept.append((zone, text, unique))
            if zone == MAIN:
                size, lost = size + n, lost + n * (not unique)
        copy = 2 * lost >= size  # notices are the lesser part; a main element of which most is repeated is a copy
        out.append("\n".join(text for zone, text, unique in kept if unique or zone == MAIN and copy))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages → id, url, text, n_chars.

    One row per input row. The host is what stands between // and the next / ? or # of the url; pages without one
    share a nameless host. Null and empty html give an empty text. Ids and urls may be null or repeat. Pages of a host with equal blocks are
    copies: each has its text, and what only copies of one page share is not repeated. Other columns are not read.

    Every host's pages go through its suffix array, whatever their markup. Hosts are counted by their urls; blocks are shuffled once, by host and, for
    hosts of more than PAGES pages, a number, so that a hot host is many small groups. A task holds one group of about PAGES pages at a time. What the groups of
    a hot host share is counted before: the different pages that have each hashed run or short block; each group gets the counts of its own that two or more
    pages of the host have. Pages of hot hosts are parsed for the counts and again for the groups, as blocks of all pages, stored and shuffled, would be on disk twice.
    """
    kind, url_kind = pages.schema[id_col].dataType.simpleString(), pages.schema[url_col].dataType.simpleString()
    host = F.coalesce(F.regexp_extract(F.col(url_col), r"//([^/?#]*)", 1), F.lit(""))
    rows = small_batches(pages).select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [blocks_of(x) for x in b.column(2).to_pylist()]
            content = pa.array(map(content_hash, found), pa.int64())
            zones = pa.array([[z for z, _ in f] for f in found], pa.list_(pa.int8()))
            texts = pa.array([[t for _, t in f] for f in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), b.column(4), content, zones, texts], names=["id", "url", "host", "parts", "content", "zones", "texts"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        seen: set[tuple] = set()

        def rows() -> pa.RecordBatch:
            cols = zip(zip(*seen), (pa.int64(), pa.int64(), pa.string(), pa.int64()))
            out = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in cols], names=["run", "content", "host", "part"])
            seen.clear()
            return out

        for b in batches:
            for h, p, content, zones, texts in zip(*(c.to_pylist() for c in b.columns)):
                blocks = list(zip(zones, texts))
                own = [*np.unique(run_hashes(h, outside(blocks), known)).tolist(), *(block_hash(h, t) for t in short_blocks(blocks)), block_hash(h, _BREAK)]
                seen.update((r, content, h, p) for r in own)
                if len(seen) > 100_000:
                    yield rows()
        if seen:
            yield rows()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream() -> Iterator[tuple]:
            for b in batches:
                kinds[:] = [b.column(0).type, b.column(1).type]
                yield from zip(*(c.to_pylist() for c in b.columns))

        def batch(group: list[tuple], elsewhere: dict[int, int]) -> pa.RecordBatch:
            host, hot = group[0][2], group[0][8] > 1
            n_pages = elsewhere.get(block_hash(host, _BREAK), 1) if hot else None  # a break stands for the whole page
            texts = main_texts([list(zip(x[4], x[5])) for x in group], elsewhere, n_pages, host)
            return pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in group], kinds[0]), pa.array([g[1] for g in group], kinds[1]), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

        kinds: list = []
        for _, own in groupby(stream(), key=lambda x: (x[2], x[3])):
            group, elsewhere = [], {}
            for x in own:
                if x[6] is not None:  # the group's runs come before its pages
                    elsewhere[x[6]] = x[7]
                    continue
                group.append(x)
                if len(group) == 4 * PAGES and x[8] > 1:  # a group of a hot host, dealt unevenly; its runs are counted by host
                    yield batch(group, elsewhere)
                    group = []
            if group:
                yield batch(group, elsewhere)

    columns = ["id", "url", "host", "part", "zones", "texts"]
    part = F.pmod(F.xxhash64("id", "url", "content"), F.col("parts")).alias("part")

    def parsed(of: DataFrame) -> DataFrame:
        return of.mapInArrow(parse, f"id {kind}, url {url_kind}, host string, parts long, content long, zones array<tinyint>, texts array<string>")

    with tidy(pages.sparkSession):
        sizes = rows.groupBy(F.col("host").alias("h")).agg(F.ceil(F.count("*") / PAGES).cast("long").alias("parts"))
        hot = stored(sizes.where("parts > 1"), "hot-hosts")
        n_hot = hot.count()
        hot = F.broadcast(hot) if n_hot <= BROADCAST_HOSTS else hot
        same = F.col("host") == F.col("h")
        if n_hot:
            own = parsed(rows.join(hot, same).select("id", "url", "html", "host", "parts")).select("host", part, "content", "zones", "texts").mapInArrow(runs, "run long, content long, host string, part long")
            by_page = own.groupBy("run", "content").agg(F.collect_set(F.struct("host", "part")).alias("asking"))
            shared = by_page.groupBy("run").agg(F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_list("asking"))).alias("asking")).where("n > 1")
            told = stored(shared.select("run", "n", F.explode("asking").alias("to")).select("run", "n", "to.host", "to.part"), "shared-runs")
    every = rows.join(hot, same, "left").select("id", "url", "html", "host", F.coalesce("parts", F.lit(1)).alias("parts")) if n_hot else rows.withColumn("parts", F.lit(1).cast("long"))
    dealt = parsed(every).select(*columns[:3], part, *columns[4:], F.lit(None).cast("long").alias("run"), F.lit(None).cast("long").alias("n"), "parts")
    if n_hot:
        nothing = [F.lit(None).cast(dealt.schema[c].dataType).alias(c) for c in columns]
        dealt = dealt.unionByName(told.select(*nothing[:2], "host", "part", *nothing[4:], "run", "n", F.lit(None).cast("long").alias("parts")))
    dealt = dealt.repartition("host", "part").sortWithinPartitions("host", "part", F.desc_nulls_last("run"))
    return dealt.mapInArrow(decide, f"`{id_col}` {kind}, `{url_col}` {url_kind}, text string, n_chars long")
