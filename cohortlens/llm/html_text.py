"""Main text of web pages with a suffix array per host.

A page is cut into blocks of visible text. Menus, headers, footers, sidebars, notices, adverts, forms and reader
comments are told by their elements, roles and class names and are never text; scripts, styles and markup neither. What
remains is either inside the page's article (``article``, ``main`` or the like), or, on pages that mark none, a
candidate. The token streams of a host's candidates are concatenated, with a mark between any two blocks; their suffix array shows the
substrings that several pages share. Substrings of ``MIN_TOKENS`` or more tokens on ``SHARE`` of the host's pages, and shorter whole
blocks on ``SHORT_SHARE`` of them, are boilerplate if they are on ``LEAST_PAGES`` at least: the tokens they cover are removed, all others
are kept. Pages of a host with the same blocks count as one, and a page that would lose everything loses nothing.

Pages that mark their article go the same way, among those of their host that do: all their visible blocks, furniture and article,
enter the streams, and repeats are found in them. An exact check by the elements follows: what an article holds is kept whole, as passages
that several articles share are still text of each, and what repeats leave beside it is no text. ``n_repeated`` is the number of a page's tokens
that repeats cover.

How it scales. Hosts of any size are cut into shards of at most about ``PAGES_PER_SHARD`` pages and ``CHARS_PER_SHARD`` characters by a hash of the
page, a power of two, so that a host with a third of all pages is many tasks; small hosts have one. Every shard builds its suffix array. A substring
on enough pages of a host is, in one of its shards at least, on as large a share of the shard's pages: these few
are the candidates, taken from runs of equal suffixes. Every shard then counts the pages that have a candidate, by binary search in its
suffix array; the sums over a host's shards show which are boilerplate, and each shard tells which tokens those cover. The result does not depend on
the number of shards; the only shard of a host needs no counting across shards. Pages are parsed once, and the blocks of a shard's pages travel compressed
together, as packs; copies that one task reads are sent once. On disk are these packs, once dealt and once in buckets of their shard, and the places that
repeats cover; texts follow from both as the result is read. No page is compared with all others.

The number of shards has to be known before pages are parsed: it follows from a host's rows and the length of their markup. Hosts that have far
fewer distinct blocks than that get their shards merged afterwards.

Defined results: a null html is empty, an empty page has an empty text; a page whose url is null or without host is a host of its own. White space
inside a block becomes one blank, blocks are joined in page order by one blank. Rows that repeat an id are pages of
their own; equal rows come as often as they were given. An empty table gives no rows. Further
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_groups
from ..session import Workspace

MIN_TOKENS = 8
PAGES_PER_SHARD = 2000
CHARS_PER_SHARD = 1 << 25
# A task holds so many characters of blocks before it compresses them, at this level of zstd.
CHARS_PER_PACK = 1 << 24
# What key, url and mark of a page count there.
CHARS_BESIDE = 128
PACK_LEVEL = 9
# Boilerplate is on so many pages of its host, and on this share of them.
LEAST_PAGES = 3
SHARE, SHORT_SHARE = 0.3, 0.9

# Elements whose content is never text; what they contain is not parsed for blocks.
OPAQUE = frozenset("script style template noscript iframe object svg math canvas audio video map head title".split())
# Elements that hold furniture of the page.
FURNITURE = frozenset("nav footer aside form button select option textarea input label fieldset dialog menu".split())
# Elements that hold the main text.
ARTICLE = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# An open p, or an open item of a list or table, ends where one of these starts.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main "
    "menu nav ol p pre section table ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Class names and ids that mark furniture: every word of one whole name has to be one of these, or one of _BESIDE.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice notices popup modal newsletter subscribe "
    "signup share sharing social related recommended comment comments respond disqus widget toolbar search login contentinfo "
    "complementary alert gdpr".split()
)
_BESIDE = frozenset("site top bottom left right main list area box bar container wrapper block section primary secondary".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
_ARTICLE_ROLES = frozenset("main article".split())


def _marked(*names: str) -> bool:
    """Whether one of the names, given as values of class and id, marks furniture."""
    for name in " ".join(names).lower().split():
        words = {w for w in re.split(r"[^a-z]+", name) if w}
        if words & _MARKS and words <= _MARKS | _BESIDE:
            return True
    return False


class _Blocks(HTMLParser):
    """Collects (is inside an article, text) of every block outside furniture, in page order.

    An element around an article is no furniture unless the page has another article outside all furniture. A form that
    holds more text than is left without it is none. If nothing else is left, it is all visible text.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str]] = []  # element and its kind: furniture, article or nothing
        self.count = dict.fromkeys(("furniture", "form", "hidden", "article", ""), 0)  # open elements by kind
        self.around = (0, 0)  # furniture and forms that were open where the outermost article started
        self.opaque: str | None = None
        # (is inside an article, furniture around the article, furniture, forms, text); text None is the end of a block.
        self.parts: list[tuple[bool, int, int, int, str | None]] = []

    @property
    def inside(self) -> int:
        return self.count["article"]

    def _end_block(self) -> None:
        if self.parts and self.parts[-1][4] is not None:
            self.parts.append((False, 0, 0, 0, None))

    def _pop(self) -> None:
        self.count[self.open.pop()[1]] -= 1

    def _close_to(self, at: int) -> None:
        while len(self.open) > at:
            self._pop()

    def _kind(self, tag: str, attrs: list) -> str:
        given = {name: value or "" for name, value in attrs}
        if given.get("aria-hidden") == "true" or "hidden" in given:
            return "hidden"
        if tag == "form":
            return "form"
        if tag in FURNITURE or (tag == "header" and not self.inside):
            return "furniture"
        role = given.get("role", "").strip().lower()
        names = given.get("class", ""), given.get("id", "")
        if tag in ARTICLE or role in _ARTICLE_ROLES:
            return "furniture" if _marked(*names) else "article"
        if role in _ROLES or (tag not in ("html", "body") and _marked(*names)):
            return "furniture"
        return ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.opaque:
            return
        if tag in BLOCK:
            self._end_block()
        if tag in VOID:
            return
        if tag == "body":
            # Whatever the head left open ends here.
            self._close_to(0)
        if tag in OPAQUE and tag != "head":
            self.opaque = tag
            return
        if tag in CLOSES_P:
            self._close_element("p", stop=ARTICLE | FURNITURE | {"div", "section", "td", "th", "li", "body"})
        for other in CLOSES.get(tag, ()):
            self._close_element(other, stop={"ul", "ol", "dl", "table", "select", "menu"})
        kind = "hidden" if tag == "head" else self._kind(tag, attrs)
        if kind == "article" and not self.inside:
            self.around = self.count["furniture"], self.count["form"]
        self.open.append((tag, kind))
        self.count[kind] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # A slash at the end of a start tag means nothing in HTML, but closes svg and math.
        if tag not in ("svg", "math"):
            self.handle_starttag(tag, attrs)

    def _close_element(self, tag: str, stop) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                self._close_to(at)
                return
            if name in stop:
                return

    def handle_endtag(self, tag: str) -> None:
        if self.opaque:
            if tag == self.opaque:
                self.opaque = None
            return
        if tag in BLOCK:
            self._end_block()
        if tag in VOID:
            return
        # Furniture and articles are not closed by what was opened outside them, except by their own container.
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                self._close_to(at)
                return
            if name in ("body", "html") or (tag not in BLOCK and name in BLOCK):
                return

    def handle_data(self, data: str) -> None:
        if self.opaque or self.count["hidden"]:
            return
        around = self.around if self.inside else (0, 0)
        furniture, forms = self.count["furniture"] - around[0], self.count["form"] - around[1]
        self.parts.append((self.inside > 0, around[0], furniture, forms, data))

    def _joined(self, wanted) -> list[tuple[bool, str]]:
        """Blocks of the parts that are wanted."""
        blocks, texts, inside = [], [], False
        for part in [*self.parts, (False, 0, 0, 0, None)]:
            if part[4] is None:
                text = " ".join("".join(texts).split())
                if text:
                    blocks.append((inside, text))
                texts, inside = [], False
            elif wanted(*part[:4]):
                texts.append(part[4])
                inside = part[0]
        return blocks

    def _outside_forms(self, wanted) -> tuple[list[tuple[bool, str]], Callable[..., bool]]:
        """Blocks of the parts that are wanted, without those in forms unless these hold most of them, and which parts that are."""
        every = self._joined(wanted)
        if not any(part[3] for part in self.parts):
            return every, wanted

        def formless(inside: bool, around: int, furniture: int, forms: int) -> bool:
            return not forms and wanted(inside, around, furniture, forms)

        left = self._joined(formless)
        enough = 2 * sum(len(t) for _, t in left) >= sum(len(t) for _, t in every)
        return (left, formless) if enough else (every, wanted)

    def divided(self) -> tuple[list[tuple[bool, str]], list[str]]:
        """Blocks of the page's text, and all other visible ones."""
        rules = (
            lambda inside, around, furniture, forms: inside and not around and not furniture,
            lambda inside, around, furniture, forms: inside and not furniture,
            lambda inside, around, furniture, forms: not inside and not furniture,
        )
        for rule in rules:
            blocks, chosen = self._outside_forms(rule)
            if blocks:
                return blocks, [text for _, text in self._joined(lambda *part, chosen=chosen: not chosen(*part))]
        return [(False, text) for _, text in self._joined(lambda *_: True)], []


def divided_blocks(html: str | None) -> tuple[list[tuple[bool, str]], list[str]]:
    """Blocks of a page: those of its articles if it marks any, else all candidates; and all its other visible blocks."""
    if not html:
        return [], []
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    return parser.divided()


def page_blocks(html: str | None) -> list[tuple[bool, str]]:
    """Blocks of a page: those of its articles if it marks any, else all candidates."""
    return divided_blocks(html)[0]


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ordered by their first ``depth`` tokens or more, and the rank of each, equal where those agree.

    Prefix doubling: ranks by 1, 2, 4, ... tokens, each from two ranks of the half length.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < depth and n:
        # The last doubling may overlap, so that exactly ``depth`` tokens are compared.
        step = min(length, depth - length)
        behind = np.full(n, -1, dtype=np.int64)
        behind[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 1) + behind + 1, return_inverse=True)[1].astype(np.int64)
        length += step
    return np.argsort(rank, kind="stable"), rank


def covered(n: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Which of ``n`` positions the intervals cover."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


class Streams:
    """Token streams of pages' candidate blocks, concatenated."""

    def __init__(self, pages: list[list[str]]):
        self.words = [block.split(" ") for blocks in pages for block in blocks]
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.page = np.repeat(np.arange(len(pages)), [sum(block.count(" ") + 1 for block in blocks) for blocks in pages])
        self.block = np.repeat(np.arange(len(sizes)), sizes)
        self.first = np.cumsum(sizes) - sizes
        self.left = np.repeat(self.first + sizes, sizes) - np.arange(len(self.block))
        self.sizes = sizes
        self.codes: dict[str, int] = {}
        self.tokens = np.array([self.codes.setdefault(t, len(self.codes)) for w in self.words for t in w], dtype=np.int64)

    def repeated(self, depth: int, least: int = 2, least_short: int = 2) -> np.ndarray:
        """Tokens that repeats within these pages cover: substrings of ``depth`` tokens on ``least`` pages, and whole shorter
        blocks on ``least_short``."""
        found = Substrings(self, depth)
        return found.cover(found.frequent(least, least_short))


class Substrings:
    """Substrings of ``depth`` tokens in the order of the suffixes they start, and whole shorter blocks.

    A substring is its tokens joined by blanks, and whether it is a whole shorter block.
    """

    def __init__(self, streams: Streams, depth: int):
        self.streams, self.depth = streams, depth
        order, rank = suffix_array(streams.tokens, depth)
        # Substrings end with their block.
        self.order = order[streams.left[order] >= depth]
        ranks = rank[self.order]
        self.fresh = np.r_[True, ranks[1:] != ranks[:-1]][: len(ranks)]
        self.starts = np.flatnonzero(self.fresh)
        self.ends = np.r_[self.starts[1:], len(ranks)][: len(self.starts)]
        self.short: dict[str, list[int]] = {}
        for block in np.flatnonzero(streams.sizes < depth).tolist():
            self.short.setdefault(" ".join(streams.words[block]), []).append(block)

    def _tokens(self, at: int) -> list[int]:
        return self.streams.tokens[at : at + self.depth].tolist()

    def _text(self, at: int) -> str:
        block = self.streams.block[at]
        inside = at - self.streams.first[block]
        return " ".join(self.streams.words[block][inside : inside + self.depth])

    def frequent(self, least: int, least_short: int) -> list[tuple[str, bool]]:
        """Substrings on ``least`` pages and shorter blocks on ``least_short``."""
        # Positions of equal substrings ascend, and so do their pages.
        page = self.streams.page[self.order]
        another = self.fresh | np.r_[True, page[1:] != page[:-1]][: len(page)]
        pages = np.add.reduceat(another.astype(np.int64), self.starts) if len(self.starts) else self.starts
        long = [(self._text(at), False) for at in self.order[self.starts[pages >= least]].tolist()]
        return long + [(text, True) for text in self.short if self.pages(text, True) >= least_short]

    def places(self, text: str, short: bool) -> np.ndarray:
        """Where a substring starts, found by binary search in the order of the suffixes."""
        if short:
            return self.streams.first[self.short.get(text, [])]
        wanted = [self.streams.codes.get(t, -1) for t in text.split(" ")]
        group = bisect_left(self.starts, wanted, key=lambda start: self._tokens(self.order[start]))
        if group == len(self.starts) or self._tokens(self.order[self.starts[group]]) != wanted:
            return self.order[:0]
        return self.order[self.starts[group] : self.ends[group]]

    def pages(self, text: str, short: bool) -> int:
        """Number of pages that have a substring."""
        return len(np.unique(self.streams.page[self.places(text, short)]))

    def cover(self, substrings: list[tuple[str, bool]]) -> np.ndarray:
        """Which tokens the substrings cover."""
        cover = np.zeros(len(self.streams.tokens), dtype=bool)
        for short in (False, True):
            places = [self.places(text, short) for text, is_short in substrings if is_short == short]
            if places:
                starts = np.concatenate(places)
                lengths = self.streams.sizes[self.streams.block[starts]] if short else self.depth
                cover |= covered(len(cover), starts, lengths)
        return cover


_PACK = (
    "host string, shards long, number long, shard string, keys array<string>, urls array<string>, marks array<binary>, "
    "sizes array<long>, packed binary"
)


def _packs(batches: Iterator[pd.DataFrame], chars_per_pack: int) -> Iterator[pd.DataFrame]:
    """Pages of one shard as a pack: keys, urls, marks of the content, sizes, and the blocks of their streams, compressed together.

    The streams of a page that marks its article hold all visible blocks, the ``n_text`` blocks of its text first; those of
    other pages hold the candidates. Pages whose content the task met before come in packs of their own, without blocks.
    """
    seen: set[tuple[str, bytes]] = set()
    packs: dict[tuple, list[tuple]] = {}
    held = 0
    for batch in batches:
        for key, url, html, host, shards in zip(*(batch[c] for c in ("key", "url", "html", "host", "shards")), strict=True):
            blocks, others = divided_blocks(html)
            marked = bool(blocks and blocks[0][0])
            stream = "\n".join([t for _, t in blocks] + (others if marked else []))
            mark = hashlib.md5(f"{marked} {len(blocks)}\n{stream}".encode("utf-8", "surrogatepass")).digest()
            # No host starts with a slash.
            searched_with = ("/article/" if marked else "") + (host or f"/{mark.hex()}")
            fresh = (searched_with, mark) not in seen
            seen.add((searched_with, mark))
            page = (key, url, mark, len(stream), *((marked, len(blocks), stream) if fresh else ()))
            packs.setdefault((searched_with, int(shards), int.from_bytes(mark[:8]) % int(shards), fresh), []).append(page)
            held += CHARS_BESIDE + (len(stream) if fresh else 0)
            if held >= chars_per_pack:
                yield _packed(packs)
                packs, held = {}, 0
    yield _packed(packs)


def _packed(packs: dict[tuple, list[tuple]]) -> pd.DataFrame:
    rows = []
    for (host, shards, number, fresh), pages in packs.items():
        keys, urls, marks, sizes, *content = map(list, zip(*pages, strict=True))
        # Packs without blocks enter no suffix array. They are dealt by their task, so that many copies of one content spread.
        shard = f"{host} {number}" if fresh else f"{host} {number} {TaskContext.get().partitionId()}"
        rows.append((host, shards, number, shard, keys, urls, marks, sizes, _pack(content) if fresh else None))
    return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _PACK.split(", ")], dtype=object)


def _pack(content: list[list]) -> bytes:
    text = json.dumps(content, ensure_ascii=False).encode("utf-8", "surrogatepass")
    return pa.Codec("zstd", compression_level=PACK_LEVEL).compress(text, asbytes=True)


def _unpack(packed: bytes) -> list[list]:
    return json.loads(pa.CompressedInputStream(pa.BufferReader(packed), "zstd").read())


def _pages(packs: pd.DataFrame) -> pd.DataFrame:
    """Pages of packs: key, url, mark, whether they mark their article, number of blocks of their text, and blocks."""
    rows = []
    for keys, urls, marks, packed in zip(packs["keys"], packs["urls"], packs["marks"], packs["packed"], strict=True):
        rows += zip(keys, urls, marks, *_unpack(packed), strict=True)
    return pd.DataFrame(rows, columns=["key", "url", "mark", "marked", "n_text", "stream"], dtype=object)


def _blocks(stream: str) -> list[str]:
    return stream.split("\n") if stream else []


def _runs(covered: np.ndarray) -> list[int]:
    """Where covered tokens begin and end, in turns."""
    return np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0)).tolist()


def _text(stream: str, marked: bool, n_text: int, runs: Sequence[int]) -> str:
    """A page without what repeats cover, checked against the elements: an article is whole, and nothing beside it is text."""
    blocks = _blocks(stream)
    if marked:
        return " ".join(blocks[:n_text])
    words = [w for block in blocks for w in block.split(" ")]
    kept, at = [], 0
    for start, end in zip(runs[::2], runs[1::2], strict=True):
        kept += words[at:start]
        at = end
    return " ".join(kept + words[at:])


def extract(
    pages: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    depth: int = MIN_TOKENS,
    pages_per_shard: int = PAGES_PER_SHARD,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``key``, ``url``, ``text``, ``n_chars`` and ``n_repeated``, the tokens that the host's repeats cover, of every page."""
    workspace = workspace or Workspace(pages.sparkSession)
    kind = pages.schema[key].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(url).alias("url"), F.col(html).alias("html")).withColumn("host", host)

    def shards(pages: Column, chars: Column) -> Column:
        """Shards of so many pages and characters, a power of two."""
        most = F.greatest(pages / F.lit(pages_per_shard), chars / F.lit(CHARS_PER_SHARD), F.lit(1.0))
        return F.pow(F.lit(2.0), F.ceil(F.log2(most))).cast("long")

    # First by rows and their markup, which no content exceeds. Hosts of several shards are few: each has many rows or long ones.
    of_host = rows.filter("host != ''").groupBy("host").agg(shards(F.count("*"), F.sum(F.length("html"))).alias("shards"))
    large = workspace.write(of_host.filter("shards > 1"), "large")
    sized = rows.join(F.broadcast(large), "host", "left").withColumn("shards", F.coalesce("shards", F.lit(1).cast("long")))
    chars_per_pack = CHARS_PER_PACK
    packs = sized.mapInPandas(lambda batches: _packs(batches, chars_per_pack), _PACK)
    # In buckets of the shard: what reads it shard by shard shuffles no page.
    dealt = workspace.write_bucketed(packs, "dealt", "shard")
    # Then by what a large host has without copies: where that needs fewer shards, some are merged.
    content = F.explode(F.arrays_zip("marks", "sizes")).alias("page")
    distinct = dealt.filter("shards > 1").select("host", "shards", content).select("host", "shards", "page.*").distinct()
    merged = F.least("shards", shards(F.count("*"), F.sum("sizes"))).alias("merged")
    hosts = workspace.write(distinct.groupBy("host", "shards").agg(merged, F.count("*").alias("pages")), "hosts")
    placed = dealt.join(F.broadcast(hosts.drop("shards")), "host", "left")
    number = F.pmod("number", F.coalesce("merged", "shards"))
    final = {"shard": F.concat_ws(" ", "host", number), "shards": F.coalesce("merged", "shards")}
    kept = ("host", "shards", "pages", "shard", "keys", "urls", "marks", "packed")
    parts = [placed.filter("packed is not null and (merged is null or merged = shards)").select(*kept)]
    if not hosts.filter("merged < shards").isEmpty():
        fewer = placed.filter("packed is not null and merged < shards").withColumns(final)
        parts.append(workspace.write_bucketed(fewer.select(*kept), "merged", "shard"))

    repeat = "host string, shards long, substring string, short boolean"
    schema = "key string, url string, host string, mark binary, text string, n_repeated long"
    covered_by = "host string, shard string, mark binary, runs array<long>"

    def needed(pages: int) -> tuple[int, int]:
        """Pages of a host on which a substring, and a shorter block, is boilerplate."""
        long, short = (max(LEAST_PAGES, int(np.ceil(pages * share))) for share in (SHARE, SHORT_SHARE))
        return long, short

    def substrings(pages: pd.DataFrame) -> Substrings:
        return Substrings(Streams([_blocks(s) for s in pages["stream"]]), depth)

    def none(schema: str) -> pd.DataFrame:
        return pd.DataFrame({c.split(" ")[0]: [] for c in schema.split(", ")}, dtype=object)

    def frequent(packs: pd.DataFrame) -> pd.DataFrame:
        # What is on enough pages of the host is on that share of them in one shard at least.
        distinct = _pages(packs).drop_duplicates("mark")
        pages = int(packs["pages"].iloc[0])
        found = substrings(distinct).frequent(*(-(-n * len(distinct) // pages) for n in needed(pages)))
        own = {"host": packs["host"].iloc[0], "shards": int(packs["shards"].iloc[0])}
        return pd.DataFrame([own | {"substring": text, "short": short} for text, short in found], columns=["host", "shards", "substring", "short"])

    def counted(packs: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(packs) or not len(wanted):
            return none(f"{repeat}, needed long, n long")
        found = substrings(_pages(packs).drop_duplicates("mark"))
        least = needed(int(packs["pages"].iloc[0]))
        n = [found.pages(text, short) for text, short in zip(wanted["substring"], wanted["short"], strict=True)]
        return wanted.drop(columns="shard").assign(needed=[least[short] for short in wanted["short"].astype(int)], n=n)

    def for_shards(repeats: DataFrame) -> DataFrame:
        number = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
        return repeats.select("host", number.alias("shard"), "shards", "substring", "short").withColumn("shard", F.concat_ws(" ", "host", "shard"))

    def covers(packs: pd.DataFrame, distinct: pd.DataFrame, found: Substrings, repeats: list[tuple[str, bool]]) -> pd.DataFrame:
        """The tokens of each page that the repeats cover, if any."""
        gone, page = found.cover(repeats), found.streams.page
        # Repeats never empty a page.
        gone &= np.bincount(page, ~gone, minlength=len(distinct))[page] > 0
        ends = np.searchsorted(page, np.arange(len(distinct) + 1))
        runs = [(mark, _runs(gone[a:b])) for mark, a, b in zip(distinct["mark"], ends, ends[1:], strict=False)]
        own = packs["host"].iloc[0], packs["shard"].iloc[0]
        return pd.DataFrame([(*own, *of) for of in runs if of[1]], columns=["host", "shard", "mark", "runs"], dtype=object)

    def whole_host(packs: pd.DataFrame) -> pd.DataFrame:
        # The only shard of its host sees all pages: what is frequent in it is boilerplate. Smaller hosts can have none.
        distinct = _pages(packs).drop_duplicates("mark")
        found = substrings(distinct) if len(distinct) >= LEAST_PAGES else None
        repeats = found.frequent(*needed(len(distinct))) if found else []
        return covers(packs, distinct, found, repeats) if repeats else none(covered_by)

    def clean(packs: pd.DataFrame, repeats: pd.DataFrame) -> pd.DataFrame:
        if not len(packs) or not len(repeats):
            return none(covered_by)
        distinct = _pages(packs).drop_duplicates("mark")
        return covers(packs, distinct, substrings(distinct), list(zip(repeats["substring"], repeats["short"], strict=True)))

    def texts(packs: pd.DataFrame, pages: pd.DataFrame, runs: Iterable) -> pd.DataFrame:
        """What the repeats leave of each page."""
        of_page = [() if of is None else of for of in runs]
        values = [_text(*page, of) for *page, of in zip(pages["stream"], pages["marked"], pages["n_text"], of_page, strict=True)]
        repeated = [int(sum(of[1::2]) - sum(of[::2])) for of in of_page]
        own = {c: pages[c].to_numpy(dtype=object) for c in ("key", "url", "mark")}
        result = pd.DataFrame(own | {"text": pd.Series(values, dtype=object), "n_repeated": np.array(repeated, dtype=np.int64)})
        result.insert(2, "host", pd.Series([packs["host"].iloc[0]] * len(result), dtype=object))
        return result

    def every_text(packs: pd.DataFrame, covered: pd.DataFrame) -> pd.DataFrame:
        if not len(packs):
            return none(schema)
        pages = _pages(packs)
        runs = dict(zip(covered["mark"], covered["runs"], strict=True))
        return texts(packs, pages, map(runs.get, pages["mark"]))

    def copied_text(packs: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(packs) or not len(wanted):
            return none(schema)
        runs = dict(zip(wanted["mark"], wanted["runs"], strict=True))
        pages = _pages(packs).drop_duplicates("mark")
        pages = pages[pages["mark"].isin(list(runs))].reset_index(drop=True)
        return texts(packs, pages, map(runs.get, pages["mark"]))

    def decided(part: DataFrame) -> DataFrame:
        """The covered tokens of the pages in some hosts."""
        found = part.filter("shards = 1").groupBy("shard").applyInPandas(whole_host, covered_by)
        # Only hosts of several shards need what is frequent in one to be counted in the others.
        if not hosts.filter("merged > 1").isEmpty():
            many = part.filter("shards > 1")
            candidate = many.groupBy("shard").applyInPandas(frequent, repeat).distinct()
            wanted = workspace.write(for_shards(candidate), "wanted")
            counts = many.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInPandas(counted, f"{repeat}, needed long, n long")
            totals = counts.groupBy("host", "shards", "substring", "short").agg(F.sum("n").alias("n"), F.max("needed").alias("needed"))
            known = workspace.write(for_shards(totals.filter("n >= needed")), "boilerplate")
            found = found.unionByName(many.groupBy("shard").cogroup(known.groupBy("shard")).applyInPandas(clean, covered_by))
        return workspace.write(found, "covered")

    def cogrouped(function: Callable, others: list[DataFrame]) -> DataFrame:
        """What a function makes of each shard's packs and the other rows of the shard, over all parts."""
        made = (p.groupBy("shard").cogroup(o.groupBy("shard")).applyInPandas(function, schema) for p, o in zip(parts, others, strict=True))
        return reduce(DataFrame.unionByName, made)

    # Texts are written nowhere: what repeats cover is, and the texts follow from the packs.
    coverage = [decided(part) for part in parts]
    every = cogrouped(every_text, coverage)
    # Copies that were not sent take the text of the one that was.
    page = F.explode(F.arrays_zip("keys", "urls", "marks")).alias("page")
    late = placed.filter("packed is null").withColumns(final).select("host", "shard", page)
    late = late.select("host", "shard", *(F.col(f"page.{c}s").alias(c) for c in ("key", "url", "mark")))
    # Written, so that the planner knows how few they are and shuffles no text for them.
    copies = workspace.write(late.groupBy("host", "shard", "mark").agg(F.count("*").alias("copies")), "copies")
    if not copies.isEmpty():
        with_runs = [copies.join(covered, ["host", "shard", "mark"], "left") for covered in coverage]
        copied = cogrouped(copied_text, with_runs).drop("key", "url").join(copies.drop("shard"), ["host", "mark"])
        others = join_groups(late.drop("shard"), workspace.write(copied, "copied"), ["host", "mark"], "copies")
        every = every.unionByName(others.select(*every.columns))
    n_chars = F.length("text").cast("long").alias("n_chars")
    return every.select(F.col("key").cast(kind).alias(key), F.col("url").alias(url), "text", n_chars, "n_repeated")
