"""Main text of web pages, with a suffix array over the pages of a host.

A page is cut into blocks (paragraphs, headings, list items and the like) with what the markup
says of each: text of an article, something that is never text of the page (menus, forms,
scripts, adverts, comments and so on), or neither, an open block. Text inside ``main`` or an
article is kept, also what repeats, since passages and copies of articles are content. Text
outside ``main`` is not, where a page has one: ``main`` is by definition what the page is about.
An article rules nothing out beside it, as it may be a teaser.

Open blocks are decided by what repeats on the host. The token stream of a page goes through all
its blocks; suffix arrays over the streams of a task's pages bring equal beginnings of ``min_words``
words together, one row for each such run and task, and the rows of all tasks are counted by host
and run. A run on two distinct pages of a host, or a whole shorter block on ``min_pages`` of them,
is boilerplate, wherever on the host these pages lie: open blocks that runs cover whole are
removed, also by runs that go on in other blocks, and of others the runs that lie within them;
unique runs stay. Pages with the same text are copies and count as one page.

A host may hold a third of all pages. Its runs are counted by an aggregate that is partial first,
so no run's pages are gathered; its open pages are cut into shards of about ``shard_bytes`` by a
hash of their key, and each gets the repeated runs that it has. Shards decide nothing: all see
the counts of the whole host. Pages without an open block are not shuffled at all.

Defined results: null html is empty and gives an empty text; a null or odd url is a host of its
own; repeated rows of one key count as one page; other columns pass through, and a column named
as a new one is replaced. An element that its class or id calls an advert, comments or the like
is out wherever the page has other live text, and stays if it has none. Runs and hosts are
compared by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ludomart.llm.common import free, in_filter, key_filter, steps, stored, with_columns
from ludomart.llm.decontaminate import suffix_array
from ludomart.llm.words import SPACE, mix, shingles, words

MIN_WORDS = 16
# Pages of a host that a shorter block has to be on.
MIN_PAGES = 3
SHARD_BYTES = 4 << 20

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DEAD = frozenset(
    "script style noscript template nav footer aside form button select option textarea iframe "
    "svg canvas object audio video head title menu dialog datalist fieldset map math".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
# An opening tag ends these open elements, unless one of ``BARRIER`` lies between.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
BARRIER = frozenset("ul ol dl table article section div main body".split())
# A class or id is a hint if it consists of these words, but for those of ``PLACE``: "site-footer"
# is one, "has-sidebar" and "comments-open" are none.
HINT = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer foot masthead pageheader siteheader "
    "topbar banner ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert comment comments disqus replies respond share sharing social "
    "related recommended subscribe newsletter signup login popup modal overlay widget pagination pager skiplink "
    "copyright legal toolbar search commentlist commentslist commentary usercomments readercomments discussion".split()
)
PLACE = frozenset(
    "site page main top bottom left right primary secondary global box block list bar wrapper container area "
    "section links buttons post posts article user users reader readers thread count".split()
)
PAIRS = (("side", "bar"), ("page", "header"), ("site", "header"), ("skip", "link"))
# Elements of a head; any other tag, or text, ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes script style template".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())


def _hint(names: str) -> bool:
    """Whether one of the classes or ids says that an element is not text of the page."""
    for name in names.lower().split():
        parts = tuple(x for x in re.split("[_-]+", name) if x)
        if parts in PAIRS or (not HINT.isdisjoint(parts) and HINT.union(PLACE).issuperset(parts)):
            return True
    return False


class _Page(HTMLParser):
    """Blocks of a page as (text, kind): kind 1 inside an article, 0 where markup says nothing.
    Dead parts give no block. A class or id is a hint only: an article is never dead for it, unless
    it lies in another one, and of a page that is all hints the least hinted text stays."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool]] = []  # name, dead, article (2: main), hint
        self.dead = self.hints = 0
        self.within = [0, 0, 0]  # open elements of each of these kinds
        self.words: list[tuple[str, int]] = []  # text and number of hints around it
        self.kind = 0
        self.parts: list[tuple[list[tuple[str, int]], int]] = []

    def end_block(self) -> None:
        if self.words:
            self.parts.append((self.words, self.kind))
            self.words = []

    def blocks(self) -> list[tuple[str, int]]:
        least = min((hints for words, _ in self.parts for data, hints in words if data.strip()), default=0)
        out = []
        for words, kind in self.parts:
            text = " ".join("".join(data for data, hints in words if hints == least).split())
            if text:
                out.append((text, kind))
        if any(kind == 2 for _, kind in out):
            out = [x for x in out if x[1] == 2]
        return [(text, min(kind, 1)) for text, kind in out]

    def _pop(self, to: int) -> None:
        while len(self.open) > to:
            _, dead, article, hint = self.open.pop()
            self.dead -= dead
            self.within[article] -= 1
            self.hints -= hint

    def _end_head(self, at_body: bool) -> None:
        if at_body:
            for i, x in enumerate(self.open):
                if x[0] == "head":
                    self._pop(i)
                    break
        elif self.open and self.open[-1][0] == "head":
            self._pop(len(self.open) - 1)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in IN_HEAD:
            self._end_head(tag == "body")
        if tag in BLOCK:
            self.end_block()
            # A paragraph ends where a block begins.
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i][0]
                if name == "p":
                    self._pop(i)
                    break
                if name in BLOCK:
                    break
        elif tag == "br":
            self.words.append((" ", self.hints))
        if tag in ENDS:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in ENDS[tag]:
                    self._pop(i)
                    break
                if self.open[i][0] in BARRIER:
                    break
        if tag in VOID:
            return
        article = {"main": 2, "article": 1}.get(tag, 0)
        hint = False
        inside = self.within[1] + self.within[2] > 0
        dead = tag in DEAD or (tag == "header" and not inside)
        if attrs:
            known = dict(attrs)
            role = (known.get("role") or "").lower()
            if role == "main":
                article = 2
            elif not article and (role == "article" or (known.get("itemprop") or "").lower() == "articlebody"):
                article = 1
            named = f"{known.get('class') or ''} {known.get('id') or ''}"
            hidden = "hidden" in known or (known.get("aria-hidden") or "") == "true"
            style = (known.get("style") or "").replace(" ", "").lower()
            if tag not in ("html", "body", "main"):
                dead = dead or role in ROLES or hidden or "display:none" in style
                hint = (not article or inside) and _hint(named)
        self.open.append((tag, dead, article, hint))
        self.hints += hint
        self.dead += dead
        self.within[article] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.end_block()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._pop(i)
                return

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self._end_head(False)
        if not self.dead:
            if not self.words:
                self.kind = 2 if self.within[2] else int(self.within[1] > 0)
            self.words.append((data, self.hints))


def blocks(html: str) -> list[tuple[str, int]]:
    """(text, kind) of the blocks of a page in order."""
    page = _Page()
    page.feed(html)
    page.close()
    page.end_block()
    return page.blocks()


class _Streams:
    """Words of pages given as blocks, one a line: of each page one stream, of each block its words."""

    def __init__(self, texts: pa.Array, min_words: int) -> None:
        self.lines = [t.split("\n") if t else [] for t in texts.to_pylist()]
        self.k = min_words
        self.h, self.first = words(texts, SPACE)
        count = [line.count(" ") + 1 for row in self.lines for line in row]
        self.block = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        self.page = np.repeat(np.arange(len(self.lines)), [len(row) for row in self.lines])  # of a block

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(page, start, name) of the runs of ``min_words`` words of each stream."""
        page, name = shingles(self.h, self.first, self.k)
        size = np.diff(self.first)
        start = np.arange(len(page)) - np.searchsorted(page, page) + self.first[:-1][page]
        full = size[page] >= self.k
        return page[full], start[full], name[full].view(np.int64)

    def short(self) -> tuple[np.ndarray, np.ndarray]:
        """(block, name) of the blocks that have fewer words than a run."""
        block, name = shingles(self.h, self.block, self.k)
        few = np.diff(self.block)[block] < self.k
        return block[few], mix(name[few] ^ np.uint64(0x2545F4914F6CDD1D)).view(np.int64)


RUNS = "host bigint, shard bigint, name bigint, pages int, page bigint"


def _repeats(pages: DataFrame, min_words: int, min_pages: int, wanted=None) -> DataFrame:
    """Runs and short blocks of ``pages`` (host, shard, page, texts), of which ``page`` tells pages
    apart: name, the number of pages that makes it boilerplate, and of the pages of a task that have it
    as many. With a filter ``wanted`` only names in it."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        host, shard, own = (part.column(c).to_numpy(zero_copy_only=False) for c in ("host", "shard", "page"))
        streams = _Streams(part.column("texts"), min_words)
        page, start, name = streams.runs()
        # Behind every stream a word of its own kind, so that no suffix goes on in the next one.
        gap = np.arange(len(part))
        seq = np.zeros(len(streams.h) + len(part), np.uint64)
        seq[np.arange(len(streams.h)) + np.repeat(gap, np.diff(streams.first))] = streams.h
        order, head = suffix_array(seq, min_words)
        group = np.empty(len(seq), np.int64)
        group[order] = np.cumsum(head)
        group = group[start + page]
        block, label = streams.short()
        page, name = np.concatenate([page, streams.page[block]]), np.concatenate([name, label])
        _, label = np.unique(label, return_inverse=True)
        group = np.concatenate([group, label + len(seq) + 1])
        need = np.where(group > len(seq), min_pages, 2)
        # Of each run, host and shard the first pages: as many as are needed to tell.
        by = np.lexsort((own[page], shard[page], host[page], group))
        key = np.stack([group[by], host[page[by]], shard[page[by]]], 1)
        new = np.append(True, (key[1:] != key[:-1]).any(1))[: len(by)]
        other = new | np.append(True, own[page[by[1:]]] != own[page[by[:-1]]])[: len(by)]
        by, new = by[other], new[other]
        begin = np.flatnonzero(new)
        place = np.arange(len(by)) - np.repeat(begin, np.diff(np.append(begin, len(by))))
        by = by[place < need[by]]
        page = page[by]
        columns = [host[page], shard[page], name[by], need[by].astype(np.int32), own[page]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["host", "shard", "name", "pages", "page"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "texts"):
                yield work(part)

    found = pages.select("host", "shard", "page", "texts").mapInArrow(run, RUNS)
    if wanted is None:
        return found

    def those(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(in_filter(batch.column("k"), wanted.value)).drop_columns(["k"])

    return found.withColumn("k", F.xxhash64("name")).mapInArrow(those, RUNS)


def _choose(texts: pa.Array, kinds: list[str], repeated: np.ndarray, min_words: int) -> list[str]:
    """The main text of each page: blocks of articles, and what does not repeat of the others."""
    streams = _Streams(texts, min_words)
    _, start, name = streams.runs()
    at = start[np.isin(name, repeated)]

    def cover(at: np.ndarray) -> np.ndarray:
        change = np.zeros(len(streams.h) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + min_words, -1)
        return np.cumsum(change[:-1]) > 0

    # Runs that go across blocks take whole blocks only, or the first words of unique text behind
    # a repeated block would go with it if they are common words.
    covered = cover(at)
    ends = np.searchsorted(streams.block, at, side="right")
    inside = cover(at[at + min_words <= streams.block[ends]]) if len(at) else covered
    block, label = streams.short()
    gone = np.zeros(len(streams.page), bool)
    gone[block[np.isin(label, repeated)]] = True
    out, j = [], 0
    for row, kind in zip(streams.lines, kinds, strict=True):
        kept = []
        for line, k in zip(row, kind, strict=True):
            cut = slice(streams.block[j], streams.block[j + 1])
            hit = inside[cut]
            gone[j] |= covered[cut].all()
            if k == "1" or not (gone[j] or hit.any()):
                kept.append(line)
            elif not gone[j]:
                kept.append(" ".join(w for w, c in zip(line.split(" "), hit, strict=True) if not c))
            j += 1
        out.append(" ".join(kept))
    return out


def extract(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    keep: list[str] | None = None,
    min_words: int = MIN_WORDS,
    min_pages: int = MIN_PAGES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``pages`` (or their columns ``keep``) with text and n_chars."""
    kept = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    host = F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host_, key_, texts_, kinds_, shard_, n_ = free(pages, "_host", "_key", "_texts", "_kinds", "_shard", "_n")
    pages = pages.withColumns({host_: F.xxhash64(host), key_: F.xxhash64(F.col(f"`{key}`"))})

    def make():
        def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
            rows = [blocks(h) if h else [] for h in part.column(html).to_pylist()]
            return {
                texts_: pa.array(["\n".join(t for t, _ in r) for r in rows], pa.string()),
                kinds_: pa.array(["".join(str(k) for _, k in r) for r in rows], pa.string()),
            }

        return work

    # Blocks hold no line breaks, so they are kept as lines.
    fields = [StructField(texts_, StringType()), StructField(kinds_, StringType())]
    parsed = stored(with_columns(pages, html, fields, make, [*kept, host_, key_]), "blocks")
    columns = [F.col(f"`{c}`") for c in kept]
    marked = parsed.where(~F.col(kinds_).contains("0"))
    clear = marked.select(*columns, F.translate(texts_, "\n", " ").alias("text"))
    clear = clear.withColumn("n_chars", F.length("text").cast("long"))

    unclear = parsed.where(F.col(kinds_).contains("0"))
    sizes = unclear.groupBy(host_).agg(F.ceil(F.sum(F.octet_length(texts_)) / shard_bytes).alias(n_)).where(F.col(n_) > 1)
    shard = F.pmod(key_, F.coalesce(n_, F.lit(1)))
    # Written first: Spark then knows its size and joins it in place if it is small, so that
    # the pages of a large host are not brought together for the join.
    unclear = unclear.join(stored(sizes, "hosts"), host_, "left").withColumn(shard_, shard).drop(n_)

    def named(df: DataFrame, shard) -> DataFrame:
        # Copies of a page are one page.
        return df.select(F.col(host_).alias("host"), shard.alias("shard"), F.xxhash64(texts_).alias("page"), F.col(texts_).alias("texts"))

    runs = stored(_repeats(named(unclear, F.col(shard_)), min_words, min_pages), "runs")
    beside = _repeats(named(marked, F.lit(-1).cast("long")), min_words, min_pages, key_filter(runs, "name"))
    count = runs.union(beside).groupBy("host", "name", "pages").agg(F.countDistinct("page").alias("n"))
    repeated = count.where("n >= pages").select("host", "name")
    hits = runs.select("host", "shard", "name").distinct().join(repeated, ["host", "name"], "left_semi").select("host", "shard", "name")
    out = StructType([*(parsed.schema[c] for c in kept), StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        repeated = right.column("name").to_numpy()
        texts = left.column(texts_).combine_chunks()
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
        chosen = _choose(texts, left.column(kinds_).to_pylist(), repeated, min_words)
        own = [left.column(c) for c in kept]
        return pa.Table.from_arrays([*own, pa.array(chosen, pa.string()), pa.array([len(t) for t in chosen], pa.int64())], names=[*kept, "text", "n_chars"])

    rest = unclear.groupBy(host_, shard_).cogroup(hits.groupBy("host", "shard")).applyInArrow(run, out)
    return clear.union(rest)
