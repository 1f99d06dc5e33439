"""Substring dedup (operator 3) by recompression.

Rounds replace runs of equal symbols, then pairs of a 'left' and a 'right' symbol, by new names. A name is a hash of
what it stands for, and a symbol's side is a bit of its name, so every task names equal runs and pairs alike and a
round needs no dictionary: equal substrings get the same symbols inside, wherever they stand. Only near their ends
may symbols differ, where the choice depends on words outside. Each symbol therefore carries its reach: the span of
words that decided it. A symbol whose reach lies in a window exists in every copy of this window.

1. Each task reports the symbols of its documents; Spark finds, by symbol, the least and greatest document.
2. A window can be a repeat only if all symbols that it determines occur in other documents too. Such windows,
   and those that determine none, are fingerprinted: two independent hashes, 96 bits, of all their words.
3. Spark finds the least document of each fingerprint, and removes the windows that start in a lesser document.

So no repeat is lost, and only a few windows of ordinary text are fingerprinted. Words and windows are those of the
input: what is removed from one document still counts against the next. Rows with a null id or null text are kept as
they are and count against none; rows that share an id don't count against each other. Columns other than the
results pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.common import discard, packed, stored, unpacked

WINDOW = 50
#: Rounds of naming, and the words that a pair's name may span. Reaches then stay well inside a window.
ROUNDS, SPAN = 6, 10
#: Symbols of fewer words are too common to tell much and aren't reported.
LEAST_WORDS = 5
#: Characters of text parsed at a time, and bytes of a word above which its hash is made alone.
CHUNK_CHARS, LONG_WORD = 1_000_000, 128

_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end in bytes whose last one is a separator: space or 9 to 13."""
    inside = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    turn = np.flatnonzero(np.diff(inside, prepend=False))
    return turn[::2], turn[1::2]


def _word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word: lanes of 8 bytes, the last filled up with zeros, are mixed in turn; long words go one by one."""
    import xxhash

    size = stop - start
    out = _mix(size.astype(np.uint64) + _A)
    padded = np.append(data, np.zeros(8, np.uint8))
    left = np.flatnonzero(size <= LONG_WORD)
    lane = 0
    while len(left):
        at, n = start[left] + lane, np.minimum(size[left] - lane, 8)
        value = np.zeros(len(left), np.uint64)
        for k in range(8):
            value |= np.where(k < n, padded[at + k], 0).astype(np.uint64) << np.uint64(8 * k)
        out[left] = _mix(out[left] * _A ^ _mix(value + _D))
        lane += 8
        left = left[size[left] > lane]
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[start[i] : stop[i]].tobytes())
    return out


class Chunk:
    """Some documents' words as hashes: `first` and `last` bound each document, `doc` tells each word's document."""

    def __init__(self, texts: list[str], lower: bool = False):
        self.texts = [t.encode("utf-8").lower() if lower else t.encode("utf-8") for t in texts]
        data = np.frombuffer(b" ".join(self.texts) + b" ", np.uint8)
        start, stop = _spans(data)
        ends = np.cumsum(np.array([len(t) + 1 for t in self.texts], np.int64))
        self.last = np.searchsorted(start, ends).astype(np.int64)
        lengths = np.diff(self.last, prepend=0)
        self.first = self.last - lengths
        self.doc = np.repeat(np.arange(len(texts)), lengths)
        self.hash = _word_hashes(data, start, stop)

    @cached_property
    def words(self) -> list[list[bytes]]:
        return [t.split() for t in self.texts]

    def symbols(self, rounds: int = ROUNDS, span: int = SPAN):
        """Names, starts, stops, reach from and to, and documents of the symbols after the rounds."""
        name, doc = self.hash, self.doc
        start = np.arange(len(name))
        stop, low, high = start + 1, start, start + 1
        for number in range(rounds):
            if not len(name):
                break
            if number == 0:
                name, start, stop, low, high, doc = self._runs(name, start, stop, low, high, doc)
            side = (_mix(name ^ np.uint64((int(_A) * (2 * number + 1)) & (2**64 - 1))) & np.uint64(1)).astype(bool)
            after = np.append(doc[1:] == doc[:-1], False)  # has a neighbour to the right
            pair = ~side & after & np.append(side[1:], False) & (np.append(stop[1:], 0) - start <= span)
            second = np.append(False, pair[:-1])
            # a left symbol that stays alone looked at its right neighbour, a right one at its left neighbour
            next_high = np.where(after, np.append(high[1:], 0), self.last[doc] + 1)
            before = np.append(False, after[:-1])
            last_low = np.where(before, np.append(0, low[:-1]), self.first[doc] - 1)
            new_high = np.where(side, high, np.maximum(high, next_high))
            new_low = np.where(side & ~second, np.minimum(low, last_low), low)
            i = np.flatnonzero(pair)
            new_high[i] = np.maximum(high[i], high[i + 1])
            new_low[i] = np.minimum(low[i], low[i + 1])
            name, stop = name.copy(), stop.copy()
            name[i] = _mix(name[i] * _A + _mix(name[i + 1]))
            stop[i] = stop[i + 1]
            keep = ~second
            name, start, stop, low, high, doc = name[keep], start[keep], stop[keep], new_low[keep], new_high[keep], doc[keep]
        return name, start, stop, low, high, doc

    def _runs(self, name, start, stop, low, high, doc):
        new = np.append(True, (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]))
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(name)) - 1
        count = (end - at + 1).astype(np.uint64)
        d = doc[at]
        run_low, run_high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        same = d[1:] == d[:-1]
        left = np.append(self.first[d[0]] - 1, np.where(same, run_low[:-1], self.first[d[1:]] - 1))
        right = np.append(np.where(same, run_high[1:], self.last[d[:-1]] + 1), self.last[d[-1]] + 1)
        named = np.where(count > 1, _mix(name[at] + _A * count), name[at])
        return named, start[at], stop[end], np.minimum(run_low, left), np.maximum(run_high, right), d

    def reported(self, window: int):
        """Symbols that some window determines: names, documents, and the first and last window start (inclusive)."""
        name, start, stop, low, high, doc = self.symbols()
        from_, to = np.maximum(high - window, self.first[doc]), np.minimum(low, self.last[doc] - window)
        good = (from_ <= to) & (stop - start >= LEAST_WORDS)
        return name[good], doc[good], from_[good], to[good]

    def starts(self, window: int) -> np.ndarray:
        """Places where a whole window starts."""
        place = np.arange(len(self.hash))
        return place[place + window <= self.last[self.doc]] if len(place) else place

    def fingerprints(self, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes, of 64 and 32 bits, of the windows that start at `places`."""
        out = []
        for base, words in ((_C, self.hash), (_D, _mix(self.hash + _A))):
            inverse = np.uint64(pow(int(base), -1, 2**64))
            n = len(words) + 1
            powers, back = (np.multiply.accumulate(np.append(np.uint64(1), np.full(n, x))) for x in (base, inverse))
            sums = np.append(np.uint64(0), np.add.accumulate(words * back[: n - 1]))
            out.append(_mix((sums[places + window] - sums[places]) * powers[places]))
        return out[0].view(np.int64), (out[1] >> np.uint64(33)).astype(np.int32)


def _chunked(batch: pa.RecordBatch, column: str):
    """Slices of a batch with about CHUNK_CHARS of text each."""
    size = np.cumsum([len(t) for t in batch.column(column).to_pylist()])
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK_CHARS)) + 1
        yield batch.slice(at, stop - at)
        at = stop


def _member(names: np.ndarray, docs: np.ndarray, lists) -> np.ndarray:
    """Whether each name is in its document's list; `lists` is a list column."""
    sizes = np.diff(lists.offsets.to_numpy())
    theirs = _mix(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64) + _A * np.repeat(np.arange(len(lists)), sizes).astype(np.uint64))
    return np.isin(_mix(names + _A * docs.astype(np.uint64)), theirs)


def _uncovered(chunk: Chunk, places: np.ndarray, from_: np.ndarray, to: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Of the window starts, those whose window determines no bad symbol."""
    change = np.bincount(from_[bad], minlength=len(chunk.hash) + 2) - np.bincount(to[bad] + 1, minlength=len(chunk.hash) + 2)
    return places[np.cumsum(change)[places] == 0]


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, h1, h2: the fingerprints of each document's windows that a document with a lesser id holds too."""
    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunked(batch, "text"):
                name, doc, _, _ = Chunk(part.column("text").to_pylist()).reported(window)
                ids = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(ids[doc])], ["symbol", "doc_id"])

    symbols = stored(texts.mapInArrow(report, "symbol long, doc_id long"), "symbols")
    shared = stored(symbols.groupBy("symbol").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most"), "shared")
    known = symbols.join(shared, "symbol").groupBy("doc_id").agg(
        F.collect_set(F.when(F.col("least") < F.col("doc_id"), F.col("symbol"))).alias("below"),
        F.collect_set(F.when(F.col("most") > F.col("doc_id"), F.col("symbol"))).alias("above"),
    )
    none = F.array().cast("array<bigint>")
    asked = texts.join(known.withColumnRenamed("doc_id", "_doc"), F.col("doc_id") == F.col("_doc"), "left").select(
        "doc_id", "text", F.coalesce("below", none).alias("below"), F.coalesce("above", none).alias("above")
    )

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunked(batch, "text"):
                chunk = Chunk(part.column("text").to_pylist())
                name, doc, from_, to = chunk.reported(window)
                places = chunk.starts(window)
                either = [_uncovered(chunk, places, from_, to, ~_member(name, doc, part.column(c))) for c in ("below", "above")]
                later = np.zeros(len(chunk.hash) + 1, bool)
                later[either[0]] = True
                at = np.union1d(*either)
                h1, h2 = chunk.fingerprints(at, window)
                found = np.rec.fromarrays([chunk.doc[at], h1, h2, ~later[at]], names="doc,h1,h2,first")
                _, one = np.unique(found[["doc", "h1", "h2"]], return_index=True) if len(at) else (None, np.zeros(0, int))
                ids = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[found["doc"][one]]), pa.array(h1[one]), pa.array(h2[one]), pa.array(found["first"][one])], ["doc_id", "h1", "h2", "only_first"])

    windows = stored(asked.mapInArrow(candidates, "doc_id long, h1 long, h2 int, only_first boolean"), "windows")
    for done in (symbols, shared):
        discard(docs.sparkSession, done)
    least = stored(windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most"), "least")
    found = stored(windows.where("not only_first").join(least, ["h1", "h2"]).where("least < doc_id").select("doc_id", "h1", "h2"), "repeats")
    for done in (windows, least):
        discard(docs.sparkSession, done)
    return found


def substring_dedup(docs: DataFrame, window: int = WINDOW, removed: DataFrame | None = None) -> DataFrame:
    """The rows of `docs` with `text` as the kept words joined by one space, and n_words and n_removed.

    `removed`: fingerprints as `repeats` gives them; found here by default.
    """
    found = repeats(docs, window) if removed is None else removed
    # where rows share an id a fingerprint may come twice; that changes nothing
    lists = found.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("x"))
    lists = lists.select(F.col("doc_id").alias("of"), F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2"))
    joined = packed(docs, ["doc_id", "text"]).join(lists, F.col("doc_id") == F.col("of"), "left").drop("of")
    none = F.array()
    joined = joined.withColumns({"h1": F.coalesce("h1", none.cast("array<bigint>")), "h2": F.coalesce("h2", none.cast("array<int>"))})
    kept = ["doc_id", "rest"]
    schema = T.StructType([joined.schema[c] for c in kept] + [T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = batch.set_column(batch.schema.get_field_index("text"), "text", batch.column("text").fill_null(""))
            for part, was in ((p, p.column("text")) for p in _chunked(filled, "text")):
                chunk = Chunk(was.to_pylist())
                gone = np.zeros(len(chunk.hash) + 1, np.int64)
                lists = part.column("h1")
                some = np.diff(lists.offsets.to_numpy()) > 0
                places = chunk.starts(window)
                places = places[some[chunk.doc[places]]] if len(places) else places
                if len(places):
                    h1, h2 = chunk.fingerprints(places, window)
                    sizes = np.diff(lists.offsets.to_numpy())
                    tag = lambda a, b, d: _mix(_mix(a.view(np.uint64) + _A * d.astype(np.uint64)) + b.astype(np.int64).view(np.uint64))
                    theirs = tag(lists.flatten().to_numpy(zero_copy_only=False), part.column("h2").flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes))
                    hit = places[np.isin(tag(h1, h2, chunk.doc[places]), theirs)]
                    np.add.at(gone, hit, 1)
                    np.add.at(gone, hit + window, -1)
                covered = np.cumsum(gone)[:-1] > 0
                texts, lost = [], []
                for words, a, b in zip(chunk.words, chunk.first, chunk.last):
                    mask = covered[a:b]
                    n = int(mask.sum())
                    lost.append(n)
                    texts.append(b" ".join([w for w, m in zip(words, mask) if not m] if n else words).decode("utf-8"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(texts, pa.string()), pa.array(chunk.last - chunk.first, pa.int64()), pa.array(lost, pa.int64())], schema.names
                )

    cut_docs = joined.mapInArrow(cut, schema)
    return unpacked(cut_docs, {c: F.col(c) for c in ("text", "n_words", "n_removed")}, ["doc_id"])
