"""Byte-level BPE encoding and decoding (operator 7).

Bytes map to the 256 Latin-1 code points, so that pyahocorasick, which matches strings, finds every
vocabulary entry inside a piece in one pass. The encoder then walks the piece from left to right with the
longest entry at each place. An entry may follow the one before it only if byte pair encoding of the two
joined would give exactly these two; that test is memoised per pair of ids. When no entry fits, the place is
marked as a dead end and the walk goes back. Each place is marked once at most, so the work is linear in the
length of the piece, and the ids equal those of merging pairs by rank.

Nulls encode like empty texts: no ids. Decoding null gives null; an id outside the vocabulary raises an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Pieces in each of the two generations that a worker remembers; a full one replaces the older.
PIECE_MEMORY = 200_000
#: Pairs of ids whose compatibility a worker remembers; past this bound the memory starts afresh.
PAIR_MEMORY = 500_000
#: Longest piece that is remembered.
PIECE_CHARS = 64


class _Pieces(dict):
    """Ids by piece, made on demand; of two generations the older goes when the newer is full."""

    def __init__(self, encode_piece):
        self.encode_piece, self.older = encode_piece, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece) or tuple(self.encode_piece(piece.encode("utf-8")))
        if len(piece) <= PIECE_CHARS:
            if len(self) >= PIECE_MEMORY:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class BytePairs:
    """A vocabulary given by ranks: {bytes: rank}."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.entry = [b""] * (max(ranks.values()) + 1)
        for entry, rank in ranks.items():
            self.entry[rank] = entry
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, entry in enumerate(self.entry):
            ids = self._merged(entry, rank) if len(entry) > 1 else [rank]
            if len(ids) == 2:
                self.parts[rank] = (ids[0], ids[1])
                self.joined[ids[0], ids[1]] = rank
            elif len(entry) == 1:
                self.parts[rank] = (rank, rank)
        self.trie = ahocorasick.Automaton()
        for rank in self.parts:
            entry = self.entry[rank]
            self.trie.add_word(entry.decode("latin-1"), rank)
        self.trie.make_automaton()
        self.length = [len(entry) for entry in self.entry]
        self.shorter = [-1] * len(self.entry)  # the longest entry that is a proper prefix
        for rank in self.parts:
            entry = self.entry[rank]
            self.shorter[rank] = next((r for k in range(len(entry) - 1, 0, -1) if (r := ranks.get(entry[:k])) in self.parts), -1)
        self.number = list(map(str, range(len(self.entry))))
        self.fits: dict[int, bool] = {}
        self.pieces = _Pieces(self.encode_piece)

    def _merged(self, entry: bytes, below: int) -> list[int]:
        """Merges by rank, with entries under `below` only; used on vocabulary entries, which are short."""
        parts = [entry[i : i + 1] for i in range(len(entry))]
        while len(parts) > 1:
            best = min(((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(below, 0))
            if best[0] >= below:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps these two neighbours apart.

        Only the entries along the touching edges matter: the right parts of the left one and the left parts of
        the right one, undone in the reverse order of their merges. If a pair across the edge has a rank that
        comes before the later of the two merges that used up its sides, it would have been merged first.
        """
        known = self.fits.get(left << 32 | right)
        if known is not None:
            return known
        a, b, bound, fine = left, right, len(self.entry), True
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < bound:
                fine = False
                break
            inner_a, inner_b = self.parts[a][1], self.parts[b][0]
            undo_a = inner_a != a and (a > b or inner_b == b)
            if undo_a:
                bound, a = a, inner_a
            elif inner_b != b:
                bound, b = b + 1, inner_b  # of equal ranks the left place merges first
            else:
                break
        if len(self.fits) >= PAIR_MEMORY:
            self.fits.clear()
        self.fits[left << 32 | right] = fine
        return fine

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, length_of, shorter, fits = len(piece), self.length, self.shorter, self.fits
        longest = [-1] * (n + 1)
        for end, rank in self.trie.iter(piece.decode("latin-1")):  # by end, so a start's last entry is its longest
            longest[end + 1 - length_of[rank]] = rank
        alive = bytearray(b"\x01") * (n + 1)
        path: list[int] = []
        start, last, rank = 0, -1, longest[0]
        while start < n:
            while rank >= 0:
                if alive[start + length_of[rank]]:
                    if last < 0:
                        break
                    fit = fits.get(last << 32 | rank)
                    if self.compatible(last, rank) if fit is None else fit:
                        break
                rank = shorter[rank]
            if rank >= 0:
                path.append(rank)
                start += length_of[rank]
                last, rank = rank, longest[start]
            else:
                if not path:
                    raise ValueError("the vocabulary lacks a byte of this text")
                alive[start] = 0
                rank = path.pop()
                start -= length_of[rank]
                last, rank = path[-1] if path else -1, shorter[rank]
        return path

    def encode(self, text: str, find) -> list[int]:
        """Ids of a text; `find` splits it into pieces, which are encoded separately."""
        return list(chain.from_iterable(map(self.pieces.__getitem__, find(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.entry.__getitem__, ids))

    def decimal(self, ids) -> bytes:
        """The ids as decimal numbers, one space between."""
        return " ".join(map(self.number.__getitem__, ids)).encode()


@lru_cache(maxsize=4)
def load(path: str) -> BytePairs:
    """The vocabulary of a rank file (base64 entry, space, rank on each line); one per worker process."""
    with open(path, "rb") as lines:
        return BytePairs({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


@lru_cache(maxsize=4)
def splitter(pattern: str):
    import regex

    return regex.compile(pattern).findall


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Adds the array column `ids` to the columns `keep` (default: all but the text; `text` itself may be kept).

    Null texts get an empty array. The file at `ranks_path` must be readable on every executor. A column of
    the input with the name of the output is replaced.
    """
    kept = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text]) if c != ids]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, find = load(ranks_path), splitter(pattern)
        for batch in batches:
            texts = batch.column(text)
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                lists = [coder.encode(t or "", find) for t in texts.slice(a, 256).to_pylist()]
                offsets, flat = [0], []
                for x in lists:
                    flat += x
                    offsets.append(len(flat))
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), column], [*kept, ids])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def decode(coded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Adds the binary column `out` with the bytes of `ids`; null ids give null."""
    kept = [c for c in coded.columns if c != out]
    schema = T.StructType([coded.schema[c] for c in kept] + [T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(ranks_path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                data = pa.array([None if x is None else coder.decode(x) for x in part.column(ids).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), data], [*kept, out])

    return coded.select(*kept).mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all but the text) with n_tokens, and ids_sha256 and decoded_sha256: lower-case hex
    digests of the ids, as decimal numbers with a space between, and of the bytes that decoding these ids gives.

    Encodes, decodes and digests in one pass, so that no id list leaves the worker. Columns of the input with the
    names of the results are replaced. Null texts count as empty.
    """
    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text]) if c not in made]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(made[0], T.LongType(), False)] + [T.StructField(c, T.StringType(), False) for c in made[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, find = load(ranks_path), splitter(pattern)
        for batch in batches:
            rows = []
            for value in batch.column(text):
                ids = coder.encode(value.as_py() or "", find)
                rows.append((len(ids), sha256(coder.decimal(ids)).hexdigest(), sha256(coder.decode(ids)).hexdigest()))
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(x, k) for x, k in zip(columns, (pa.int64(), pa.string(), pa.string())))], [*kept, *made])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)
