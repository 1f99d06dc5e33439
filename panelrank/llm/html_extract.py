"""Main text of web pages: structure says where the article is, and a suffix array of the host what all its pages repeat.

A page is read into blocks of text. Blocks inside an `article` (else inside `main` or what is named so) are the main text; menus,
headers, footers, sidebars, notices, adverts, forms and reader comments are left out by element, role or name wherever they stand.
The whole page, article or not, joins the token stream of the host. The suffix array of a host's stream finds the substrings of
`repeat` tokens or more that stand on different pages. What they cover on two pages outside of the articles is boilerplate, unless it
lies in such a substring of an article; a page without an article keeps the rest. Text inside an article is never left out as a
repeat: articles are copied and quoted between pages, and that is their text, on pages without an article too.

Streams of large hosts are dealt over shards of about `shard_tokens` tokens with a suffix array each; shards meet by the 64-bit
contents of their substrings, dealt over as many slices, so results do not depend on the shards. Pages with the same stream are one
page here: a copy is no repeat.

Null and empty html give an empty text. Broken, cut and very long pages are read to their end: a tag cut off at the end is markup, an
open element ends with the page, a `<` before no letter is text. White space is what Unicode calls so. Repeated rows are pages
of their own; pages without a host share one. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.llm.common import arrow_batches, lean_disk, stored
from panelrank.llm.url_filter import host_of

_TAG = re.compile(r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Fixed values of HTML: elements without content, those of a head, with text that is no markup, and that begin a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("head base link meta noscript script style template title".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
LINES = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead title tr ul".split()
)
#: Elements, roles and words of names that say what is not the article.
ASIDE = frozenset("aside button canvas datalist dialog footer form head iframe input menu nav noscript object search select svg template textarea".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer gdpr login masthead "
    "menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
BODY = (frozenset("article entry post story".split()), frozenset("body content main text".split()))


class _Open:
    """An open element: whether it leaves its content out, and the level of the article it begins (2 article, 1 main, 0 none)."""

    __slots__ = ("name", "out", "level")

    def __init__(self, name: str, out: bool, level: int):
        self.name, self.out, self.level = name, out, level


def _opened(name: str, attributes: str, inside: bool) -> _Open:
    given: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes) if "=" in attributes else ():
        given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    words = {w.lower() for w in _WORD.findall(given.get("class", "") + " " + given.get("id", ""))}
    role = given.get("role", "").lower()
    if name in ("html", "body"):
        return _Open(name, False, 0)
    if name in ("article", "main") or role in ("main", "article"):
        comment = words & {"comment", "comments"}
        return _Open(name, bool(comment), 0 if comment else 2 if "article" in (name, role) else 1)
    out = name in ASIDE or role in ROLES or bool(words & NAMES) or (not inside and (name == "header" or "header" in words))
    return _Open(name, out, 1 if not out and words & BODY[0] and words & BODY[1] else 0)


def blocks(page: str | None) -> list[tuple[str, str, int, bool]]:
    """(element, text, level, left out by structure) of each block of text in page order."""
    page = page or ""
    out: list[tuple[str, str, int, bool]] = []
    stack: list[_Open] = []
    names: Counter = Counter()
    held: list[str] = []
    left_out, levels, line = 0, [0], "body"

    def say(text: str) -> None:
        if text:
            held.append(entities.unescape(text) if "&" in text else text)

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append((line, text, levels[-1], left_out > 0))
        held.clear()

    def close(name: str) -> None:
        nonlocal left_out
        while True:
            top = stack.pop()
            names[top.name] -= 1
            left_out -= top.out
            if top.level:
                levels.pop()
            if top.name == name:
                return

    def within(name: str, borders: tuple[str, ...]) -> bool:
        """Whether the nearest of `name` and `borders` that is open is `name`."""
        if names[name]:
            for o in reversed(stack):
                if o.name == name or o.name in borders:
                    return o.name == name
        return False

    at = 0
    for m in iter(lambda: _TAG.search(page, at), None):
        say(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in LINES:
            flush()
            line = name if not m[1] else "body"
        if m[1]:
            if names[name]:
                close(name)
            continue
        if name in ("br", "td", "th"):
            say(" ")
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])|\Z", re.I).search(page, at)
            at = end.end()
            if end[0]:
                at = (page.find(">", at) + 1) or len(page)
            continue
        if name in VOID:
            continue
        if names["head"] and name not in HEAD:
            close("head")
        if name in LINES and names["p"]:
            close("p")
        if name == "li" and within("li", ("ul", "ol", "menu")):
            close("li")
        opened = _opened(name, m[3], levels[-1] > 0)
        if opened.out or opened.level:
            flush()
        if opened.level and names["form"]:  # a form around the whole page
            for o in stack:
                left_out -= o.out and o.name == "form"
                o.out &= o.name != "form"
        stack.append(opened)
        names[name] += 1
        left_out += opened.out
        if opened.level:
            levels.append(max(levels[-1], opened.level))
    say(page[at:])
    flush()
    return out


#: What a block is: left out by structure, or of the article; else what stands around it.
OUT, ARTICLE = 2, 1


def stream(parts: list[tuple[str, str, int, bool]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The words of a page, each block after a mark of its element; the tokens of each block; what each is (OUT, ARTICLE or 0)."""
    best = max((level for _, _, level, out in parts if not out), default=0)
    said = " ".join(f"<{element}> {text}" for element, text, _, _ in parts)
    states = [OUT if out else ARTICLE if best and level == best else 0 for _, _, level, out in parts]
    return said, np.array([text.count(" ") + 2 for _, text, _, _ in parts], np.int32), np.array(states, np.uint8)


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _sorted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the order of the codes, whether each in that order differs from the one before)."""
    order = np.argsort(codes)
    codes = codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    return order, new


def suffix_array(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(all suffixes in the order of their first `depth` tokens, whether each begins a class of equal ones), by prefix doubling.
    ids: tokens as numbers from 0."""
    rank, k = ids.astype(np.int64), 1
    order, new = _sorted(rank) if depth == 1 else (rank, rank)
    while k < depth:
        step = min(k, depth - k)
        ahead = np.zeros(len(rank), np.int64)
        ahead[: len(rank) - step] = rank[step:] + 1
        order, new = _sorted(rank * (int(rank.max(initial=0)) + 2) + ahead)
        k += step
        if k < depth:
            rank = np.empty(len(order), np.int64)
            rank[order] = np.cumsum(new) - 1
    return order, new


def suffix_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """The ranks of all suffixes by their first `depth` tokens."""
    order, new = suffix_array(np.unique(tokens, return_inverse=True)[1], depth)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank


class Classes:
    """Classes of equal substrings: where they begin in the suffix array, whether they stand on several pages, outside of articles, so
    on several pages, and in an article."""

    def __init__(self, array: np.ndarray, begins: np.ndarray, page: np.ndarray, inside: np.ndarray):
        self.array, self.begins = array, begins
        if not len(array):
            self.repeated = self.outside = self.common = self.told = np.zeros(0, bool)
            return
        self.repeated = np.minimum.reduceat(page, begins) != np.maximum.reduceat(page, begins)
        first, last = np.minimum.reduceat(np.where(inside, len(array), page), begins), np.maximum.reduceat(np.where(inside, -1, page), begins)
        self.outside = last >= 0
        self.common = self.outside & (first != last)
        self.told = np.logical_or.reduceat(inside, begins)

    def places(self, chosen: np.ndarray) -> np.ndarray:
        return self.array[np.repeat(chosen, np.diff(np.concatenate([self.begins, [len(self.array)]])))]


class Shard:
    """The pages of a host, or of a part of it, as one stream with its suffix array."""

    def __init__(self, pages: dict[int, tuple[str, np.ndarray, np.ndarray]], depth: int):
        """pages: streams by digest."""
        self.digests, self.depth = list(pages), depth
        words = pc.split_pattern(pa.array([said for said, _, _ in pages.values() if said], pa.large_string()), " ").flatten().dictionary_encode()
        self.words, self.ids = words.dictionary, words.indices.to_numpy(zero_copy_only=False)
        sizes = np.array([tokens.sum() for _, tokens, _ in pages.values()], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.main = np.concatenate([np.zeros(0, bool), *(np.repeat(kinds == ARTICLE, tokens) for _, tokens, kinds in pages.values())])
        self.page = np.repeat(np.arange(len(sizes)), sizes)
        #: Suffixes with `depth` tokens left in their page, and those whose first `depth` tokens are all of an article.
        ends = np.arange(len(self.ids)) + depth
        self.whole = ends <= np.repeat(self.starts[1:], sizes)
        told = np.concatenate([[0], np.cumsum(self.main)])
        self.inside = self.whole & (told[np.minimum(ends, len(self.ids))] - told[:-1] == depth)

    def classes(self) -> Classes:
        array, new = suffix_array(self.ids, self.depth)
        whole, number = self.whole[array], np.cumsum(new)
        array, number = array[whole], number[whole]
        begins = np.flatnonzero(np.diff(number, prepend=0))
        return Classes(array, begins, self.page[array], self.inside[array])

    def contents(self, at: np.ndarray) -> np.ndarray:
        """A 64-bit digest of the `depth` tokens from each place."""
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words.to_pylist()), np.uint64, len(self.words))
        out = np.zeros(len(at), np.uint64)
        for k in range(self.depth):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[self.ids[at + k]]
            out ^= out >> np.uint64(29)
        return out

    def _covered(self, places: np.ndarray) -> np.ndarray:
        cover = np.bincount(places, minlength=len(self.ids) + 1) - np.bincount(places + self.depth, minlength=len(self.ids) + 1)
        return np.cumsum(cover[:-1]) > 0

    def covered(self, known: np.ndarray, states: np.ndarray) -> Iterator[tuple[int, int, int, int, int, np.ndarray]]:
        """(digest, tokens outside of the article, those of them in repeats, tokens of the article, those of them in repeats, whether each
        token is boilerplate) of each page.

        known: sorted contents that other shards have too, with the states that `_met` gives them.
        """
        found = self.classes()
        repeated, common, told = found.repeated, found.common, found.told
        if len(known) and len(found.begins):
            mine = self.contents(found.array[found.begins])
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            state = np.where(known[at] == mine, states[at], 0)
            repeated, common, told = repeated | (state > 0), common | (state & COMMON > 0), told | (state & TOLD > 0)
        covers, common, told = (self._covered(found.places(x)) for x in (repeated, common, told))
        gone = common & ~told
        for digest, a, b in zip(self.digests, self.starts, self.starts[1:]):
            main, cover = self.main[a:b], covers[a:b]
            n, copied = int(main.sum()), int((cover & main).sum())
            yield digest, int(b - a) - n, int(cover.sum()) - copied, n, copied, gone[a:b]


def _host():
    return F.coalesce(host_of(F.col("url")), F.lit("")).alias("host")


#: Pages of a shard, many to a row. Of each stream: its digest, its words (a line; zstd at LEVEL, `size` bytes), how many blocks it has, and
#: the tokens of each with what it is; and the pages: the digest of their stream, page_id and url.
DEALT = "host string, shard long, shards long, digests binary, words binary, size long, blocks binary, tokens binary, kinds binary, of binary, page_ids array<string>, urls array<string>"
LEVEL = 6
#: Text that a task holds before it writes rows.
HELD = 1 << 23


def _large(pages: DataFrame, shard_tokens: int) -> DataFrame:
    """The hosts that are dealt over shards, by the size of their pages, about six characters a token."""
    return pages.groupBy(_host()).agg(F.ceil(F.sum(F.length("html")) / (6 * shard_tokens)).cast("long").alias("shards")).where("shards > 1").withColumnRenamed("host", "of")


def _dealt(pages: DataFrame, large: DataFrame, join: str) -> DataFrame:
    """The streams of pages by host and shard; an inner join to `large` reads the pages of large hosts only."""

    def deal(batches):
        held: dict[tuple[str, int, int], tuple[dict, list]] = {}
        size = 0

        def rows():
            for key, (found, named) in held.items():
                saids, tokens, kinds = zip(*found.values())
                words = "\n".join(saids).encode("utf-8")
                data = [np.array(list(found), np.int64), pa.Codec("zstd", LEVEL).compress(words, asbytes=True), len(words), np.array([len(t) for t in tokens], np.int32), np.concatenate(tokens), np.concatenate(kinds)]
                of, page_ids, urls = zip(*named)
                yield pd.DataFrame([(*key, *(x.tobytes() if isinstance(x, np.ndarray) else x for x in [*data, np.array(of, np.int64)]), list(page_ids), list(urls))], columns=names)
            held.clear()

        for batch in batches:
            for r in batch.itertuples(index=False):
                said, tokens, kinds = stream(blocks(r.html))
                digest = _hash(b"\0".join([said.encode("utf-8"), tokens.tobytes(), kinds.tobytes()]))
                shard = (digest if said else _hash(str(r.page_id).encode("utf-8"))) % r.shards
                found, named = held.setdefault((r.host, shard, r.shards), ({}, []))
                found[digest] = said, tokens, kinds
                named.append((digest, r.page_id, r.url))
                size += len(said)
                if size > HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    names = [part.strip().split(" ")[0] for part in DEALT.split(",")]
    given = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", _host(), "html")
    known = given.join(F.broadcast(large), F.col("host") == F.col("of"), join)
    return known.select("page_id", "url", "host", F.coalesce("shards", F.lit(1).cast("long")).alias("shards"), "html").mapInPandas(deal, DEALT)


def _unpacked(r, pages: dict, named: list) -> None:
    """Adds the streams and the pages of a dealt row; a stream is held once."""
    lines = pa.decompress(r.words, r.size, "zstd", asbytes=True).decode("utf-8").split("\n")
    tokens, kinds = np.frombuffer(r.tokens, np.int32), np.frombuffer(r.kinds, np.uint8)
    ends = np.cumsum(np.frombuffer(r.blocks, np.int32))
    for digest, said, a, b in zip(np.frombuffer(r.digests, np.int64).tolist(), lines, np.concatenate([[0], ends]), ends):
        if digest not in pages:
            pages[digest] = said, tokens[a:b], kinds[a:b]
    named += zip(np.frombuffer(r.of, np.int64).tolist(), r.page_ids, r.urls)


def _shards(dealt: DataFrame, work, schema: str) -> DataFrame:
    """`work(host, shard, shards, streams by digest, pages, known, states)` gives the rows of each shard."""

    def run(batches):
        now, pages, named, known = None, {}, [], []

        def done():
            values, states = (np.concatenate(x) for x in zip(*known)) if known else (np.zeros(0, np.uint64), np.zeros(0, np.uint8))
            order = np.argsort(values)
            yield from work(*now, pages, named, values[order], states[order])

        for batch in batches:
            for r in batch.itertuples(index=False):
                if now is None or (r.host, r.shard) != now[:2]:
                    if now is not None:
                        yield from done()
                    now, pages, named, known = (r.host, r.shard, r.shards), {}, [], []
                if r.known is not None:
                    known.append((np.frombuffer(r.known, np.uint64), np.frombuffer(r.states, np.uint8)))
                else:
                    _unpacked(r, pages, named)
        if now is not None:
            yield from done()

    return dealt.repartition("host", "shard").sortWithinPartitions("host", "shard").mapInPandas(run, schema)


#: What is known of a content that several shards have: that it is there, on pages of two shards outside of articles, in an article.
SHARED, COMMON, TOLD = 1, 2, 4


def _met(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a slice of a host's contents: those that each shard shares with others, with their states."""
    parts = [np.cumsum(np.frombuffer(p, np.uint8).reshape(8, -1).T.copy().view(np.uint64)[:, 0], dtype=np.uint64) for p in rows["steps"]]
    of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    values, states = np.concatenate(parts), np.concatenate([np.frombuffer(x, np.uint8) for x in rows["states"]])
    order = np.argsort(values, kind="stable")
    values, states, of = values[order], states[order], of[order]
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    sizes = np.diff(np.concatenate([begins, [len(values)]]))
    state = SHARED + COMMON * (np.add.reduceat((states & COMMON > 0).astype(np.int64), begins) > 1) + TOLD * (np.add.reduceat((states & TOLD > 0).astype(np.int64), begins) > 0)
    shared, state = np.repeat(sizes > 1, sizes), np.repeat(state, sizes).astype(np.uint8)
    out = []
    for i, (host, shard, shards) in enumerate(zip(rows["host"], rows["shard"], rows["shards"])):
        mine = shared & (of == i)
        if mine.any():
            out.append((host, shard, shards, values[mine].tobytes(), state[mine].tobytes()))
    return pd.DataFrame(out, columns=["host", "shard", "shards", "known", "states"])


def extract(pages: DataFrame, repeat: int = 8, shard_tokens: int = 1 << 21) -> DataFrame:
    """page_id, url, text, n_outside, n_repeated, n_article, n_copied. pages: page_id, url, html.

    text: the main text; blocks are joined by an empty line. n_outside and n_repeated: the tokens outside the article, and those of them
    that other pages of the host repeat; n_article and n_copied: those of the article.
    """
    spark = pages.sparkSession
    with arrow_batches(spark), lean_disk(spark):
        large = stored(_large(pages, shard_tokens), "hosts")
        others = stored(_shared(_dealt(pages, large, "inner"), repeat), "shared")
    dealt = _dealt(pages, large, "left").withColumns({"known": F.lit(None).cast("binary"), "states": F.lit(None).cast("binary")})
    extra = others.select(*(F.col(f.name) if f.name in others.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in dealt.schema))

    def made(host, shard, shards, pages, named, known, states):
        pages_of = defaultdict(list)
        for digest, *page in named:
            pages_of[digest].append(page)
        rows = []
        for digest, *numbers, gone in Shard(pages, repeat).covered(known, states):
            text = _text(*pages[digest], gone)
            for page in pages_of[digest]:
                rows.append((*page, text, *numbers))
                if len(rows) == 1000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
        yield pd.DataFrame(rows, columns=columns)

    columns = ["page_id", "url", "text", "n_outside", "n_repeated", "n_article", "n_copied"]
    out = _shards(dealt.unionByName(extra), made, "page_id string, url string, text string, n_outside long, n_repeated long, n_article long, n_copied long")
    return out.select(F.col("page_id").cast(pages.schema["page_id"].dataType).alias("page_id"), *columns[1:])


def _text(said: str, tokens: np.ndarray, kinds: np.ndarray, gone: np.ndarray) -> str:
    """The blocks of the article; of a page without one, what is neither left out nor boilerplate."""
    words, at, kept = said.split(" "), 0, []
    article = (kinds == ARTICLE).any()
    for size, kind in zip(tokens.tolist(), kinds.tolist()):
        block = words[at + 1 : at + size]
        if article and kind == ARTICLE:
            kept.append(" ".join(block))
        elif not article and kind != OUT:
            kept.append(" ".join(w for w, g in zip(block, gone[at + 1 : at + size].tolist()) if not g))
        at += size
    return "\n\n".join(k for k in kept if k)


def _shared(dealt: DataFrame, repeat: int) -> DataFrame:
    """What the shards of large hosts have in common."""

    def found(host, shard, shards, pages, *_):
        """A row for each slice: contents sorted, as bytes of their steps, the first bytes first, and their states."""
        s = Shard(pages, repeat)
        c = s.classes()
        if not len(c.begins):
            return
        values = s.contents(c.array[c.begins])
        order = np.argsort(values)
        values, states = values[order], (COMMON * c.outside + TOLD * c.told).astype(np.uint8)[order]
        slices = ((values >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        cuts = np.searchsorted(slices, np.arange(shards + 1).astype(np.uint64))
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                steps = np.diff(values[a:b], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
                yield pd.DataFrame([(host, number, shard, shards, steps, states[a:b].tobytes())], columns=["host", "slice", "shard", "shards", "steps", "states"])

    none = F.array().cast("array<string>")
    unnamed = dealt.withColumns({"of": F.lit(b""), "page_ids": none, "urls": none, "known": F.lit(None).cast("binary"), "states": F.lit(None).cast("binary")})
    contents = _shards(unnamed, found, "host string, slice long, shard long, shards long, steps binary, states binary")
    return contents.groupBy("host", "slice").applyInPandas(_met, "host string, shard long, shards long, known binary, states binary")
