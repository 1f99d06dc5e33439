"""Phrase collocation mining by SETM: occurrence relations are persisted, joined by adjacent position, counted and filtered.

A relation holds the occurrences of one length, sorted by piece and position. It is kept in blocks of whole pieces of one language;
positions number the words of a block and jump at the end of a piece, so words at adjacent positions share a piece. A block
extends a relation by a merge join with the words one place on and counts its groups; Spark adds the counts of all blocks up,
and what is not frequent leaves the relation before the next length (semi-join). Groups that are too many to share with tasks
are shared as a table of bits (`Sieve`), which keeps all frequent groups and lets a few others through; what these make is counted
exactly in the next length, like all else, and is not frequent either, so results are the same.

Disk: a block keeps places as bits and its words in as few bytes as they need, groups of words that are shared travel as numbers, two to
a long, and each step's shuffle files go when it ends.

Null texts count as empty and null languages as `und`. Empty and blank texts have no words. Repeated rows count once each.
A language without a frequent phrase has no row; an empty table gives no rows. Only `text` and `lang` are read, so other columns,
whatever their names, do not matter. A block is at most `block_words` words and one more document.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelrank.llm.common import arrow_batches, discard, lean_disk, stored

#: Piece separators become a byte that UTF-8 never has, tabs become spaces, A-Z become a-z.
END = b"\xff"
_BYTES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", END * 10 + b" abcdefghijklmnopqrstuvwxyz")
LONGEST = 4
#: Parts of a language that are ranked apart before the first of each meet.
PARTS = 64


def words_and_ends(text: str) -> list[bytes]:
    """Words of a text in order; the end of a piece is a word of its own, `END`."""
    return text.encode("utf-8").translate(_BYTES).replace(END, b" \xff ").split()


def _key(lang: bytes, word: bytes, seed: int) -> int:
    """A signed 64-bit number of a word of a language; `vocabulary` makes sure that no two words share one."""
    return xxhash.xxh3_64_intdigest(lang + b"\0" + word, seed) - (1 << 63)


def _languages(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Language and words of each text; Arrow's memory goes back to the system when it is freed."""
    pa.set_memory_pool(pa.system_memory_pool())
    for at in range(0, batch.num_rows, 64):
        few = batch.slice(at, 64)
        for lang, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist()):
            if text:
                yield ("und" if lang is None else lang), words_and_ends(text)


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, w, n: its occurrences), written, and the seed of w: the first under which no two words share a number."""
    spark, seed = docs.sparkSession, 0
    while True:

        def count(batches, seed=seed):
            counts: dict[str, Counter] = {}
            held = 0

            def rows():
                for lang, words in counts.items():
                    tag = lang.encode()
                    keys = list(words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys)), pa.array(keys, pa.binary()).cast(pa.string()), pa.array([_key(tag, w, seed) for w in keys], pa.int64()), pa.array(words.values(), pa.int64())], ["lang", "word", "w", "n"]
                    )
                counts.clear()

            for batch in batches:
                for lang, words in _languages(batch):
                    known = counts.setdefault(lang, Counter())
                    before = len(known)
                    known.update(words)
                    known.pop(END, None)
                    held += len(known) - before
                    if held > 100_000:
                        yield from rows()
                        held = 0
            yield from rows()

        parts = docs.select("lang", "text").mapInArrow(count, "lang string, word string, w long, n long")
        words = stored(parts.groupBy("lang", "word", "w").agg(F.sum("n").alias("n")), "words")
        if not words.groupBy("w").agg(F.count("*").alias("k")).where("k > 1").head(1):
            return words, seed
        discard(spark, words)
        seed += 1


class Groups:
    """Groups as sorted columns, to ask which of a block's are among them: asking costs a block's groups, not all groups."""

    def __init__(self, columns: list[np.ndarray]):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        codes = np.zeros(len(columns[0]), np.int64)
        for c in columns:
            values = np.unique(c)
            codes = codes * len(values) + np.searchsorted(values, c)
            ranks = np.unique(codes)  # ranked again, so that products stay under the square of the groups
            codes = np.searchsorted(ranks, codes)
            self.levels.append((values, ranks))

    def have(self, columns: list[np.ndarray]) -> np.ndarray:
        """Whether each row of the columns is a group."""
        known, codes = np.ones(len(columns[0]), bool), np.zeros(len(columns[0]), np.int64)
        for c, (values, ranks) in zip(columns, self.levels):
            if not len(values):
                return np.zeros(len(c), bool)
            at = np.minimum(np.searchsorted(values, c), len(values) - 1)
            known &= values[at] == c
            codes = codes * len(values) + at
            at = np.minimum(np.searchsorted(ranks, codes), len(ranks) - 1)
            known &= ranks[at] == codes
            codes = at
        return known


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row of the columns."""
    code = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        code = (code ^ c.astype(np.int64, copy=False).view(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            code = (code ^ (code >> np.uint64(shift))) * np.uint64(factor)
        code ^= code >> np.uint64(31)
    return code


class Sieve:
    """Groups as a table of 2^`power` bits, two for each group: `have` misses no group, and takes a few others for one."""

    #: Bits of a slice, which one task fills; bits of the largest table (32 MB).
    SLICE, MOST = 19, 28

    def __init__(self, table: np.ndarray, power: int):
        self.table, self.power = table, power

    @staticmethod
    def power_for(groups: int) -> int:
        """16 bits a group or more, up to the largest table."""
        return min(max(16 * groups, 1 << Sieve.SLICE).bit_length(), Sieve.MOST)

    @staticmethod
    def bits(columns: list[np.ndarray], power: int) -> tuple[np.ndarray, np.ndarray]:
        """The two bits of each row of the columns."""
        code = _mixed(columns)
        return (code >> np.uint64(64 - power)).astype(np.int64), (code & np.uint64((1 << power) - 1)).astype(np.int64)

    def have(self, columns: list[np.ndarray]) -> np.ndarray:
        one, two = ((self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 for at in self.bits(columns, self.power))
        return (one & two).astype(bool)

    @classmethod
    def of(cls, groups: DataFrame, columns: list[str], count: int) -> Sieve:
        power = cls.power_for(count)

        def bits(batches):
            for batch in batches:
                at = np.concatenate(cls.bits([batch.column(c).to_numpy() for c in columns], power))
                yield pa.RecordBatch.from_arrays([pa.array(at >> cls.SLICE), pa.array((at & ((1 << cls.SLICE) - 1)).astype(np.int32))], ["slice", "bit"])

        def fill(key, rows):
            mask = np.zeros(1 << cls.SLICE, bool)
            mask[rows.column("bit").to_numpy()] = True
            return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "table": pa.array([np.packbits(mask, bitorder="little").tobytes()], pa.binary())})

        made = groups.select(*columns).mapInArrow(bits, "slice long, bit int").groupBy("slice").applyInArrow(fill, "slice long, table binary").toArrow()
        table = np.zeros((1 << power) >> 3, np.uint8)
        size = (1 << cls.SLICE) >> 3
        for number, part in zip(made.column("slice").to_pylist(), made.column("table")):
            table[number * size : (number + 1) * size] = np.frombuffer(part.as_buffer(), np.uint8)
        return cls(table, power)


class Block:
    """Occurrences of a block: `keys` numbers its words; word `ids[i]` stands at `places[i]`; phrases of `length` start at `starts`."""

    def __init__(self, keys: np.ndarray, places: np.ndarray, ids: np.ndarray, starts: np.ndarray, length: int):
        self.keys, self.places, self.ids, self.starts, self.length = keys, places, ids, starts, length

    def extended(self) -> Block:
        """The merge join: phrases at adjacent positions make the phrases one word longer."""
        at = np.searchsorted(self.starts, self.starts + 1)
        at[at == len(self.starts)] = 0
        return Block(self.keys, self.places, self.ids, self.starts[self.starts[at] == self.starts + 1] if len(at) else self.starts, self.length + 1)

    def groups(self) -> tuple[list[np.ndarray], np.ndarray]:
        """(a column of keys for each word of the distinct phrases, the group of each phrase)."""
        first = np.searchsorted(self.places, self.starts)
        group = self.ids[first].astype(np.int64)
        chosen = [group]
        for k in range(1, self.length):
            pairs, group = np.unique(group * len(self.keys) + self.ids[first + k], return_inverse=True)
            chosen = [c[pairs // len(self.keys)] for c in chosen] + [pairs % len(self.keys)] if k > 1 else [pairs // len(self.keys), pairs % len(self.keys)]
        if self.length == 1:
            distinct, group = np.unique(group, return_inverse=True)
            chosen = [distinct]
        return [self.keys[c] for c in chosen], group

    def kept(self, frequent: Groups | Sieve) -> Block:
        """The semi-join: phrases whose group is frequent, and the words that they cover."""
        columns, group = self.groups()
        starts = self.starts[frequent.have(columns)[group]] if len(self.starts) else self.starts
        covered = np.zeros(len(self.places), bool)
        first = np.searchsorted(self.places, starts)
        for k in range(self.length):
            covered[first + k] = True
        used, ids = np.unique(self.ids[covered], return_inverse=True)
        return Block(self.keys[used], self.places[covered], ids.astype(np.int32), starts, self.length)


#: places: a bit for each place up to the last; starts: a bit for each of the places; ids: in the least bytes that hold them.
RELATION = "keys binary, places binary, ids binary, starts binary, length int"


def _bits(chosen: np.ndarray, size: int) -> bytes:
    mask = np.zeros(size, bool)
    mask[chosen] = True
    return np.packbits(mask).tobytes()


def _chosen(bits: pa.Scalar) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8))).astype(np.int32)


def _rows(blocks: Iterator[Block]) -> Iterator[pa.RecordBatch]:
    for b in blocks:
        if len(b.starts):
            places = _bits(b.places, int(b.places[-1]) + 1)
            ids = b.ids.astype(np.min_scalar_type(len(b.keys)))
            starts = _bits(np.searchsorted(b.places, b.starts), len(b.places))
            data = [[x] for x in (b.keys.tobytes(), places, ids.tobytes(), starts)]
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.binary()) for x in data), pa.array([b.length], pa.int32())], ["keys", "places", "ids", "starts", "length"])


def _read(batches) -> Iterator[Block]:
    for batch in batches:
        for row in range(batch.num_rows):  # a block at a time: its arrays are megabytes
            r = {n: batch.column(i)[row] for i, n in enumerate(batch.schema.names)}
            keys, places = np.frombuffer(r["keys"].as_buffer(), np.int64), _chosen(r["places"])
            ids = np.frombuffer(r["ids"].as_buffer(), np.min_scalar_type(len(keys))).astype(np.int32)
            yield Block(keys, places, ids, places[_chosen(r["starts"])], r["length"].as_py())


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _numbered(keys: np.ndarray, frequent: Groups) -> np.ndarray:
    """The numbers of frequent words: their places among the keys of all frequent words, sorted."""
    return np.searchsorted(frequent.levels[0][0], keys)


def _built(docs: DataFrame, seed: int, block_words: int, frequent) -> DataFrame:
    """Relation of frequent single words; `frequent`: a broadcast of Groups, by which words are numbered, or of a Sieve."""

    def build(batches):
        held: dict[str, tuple[_Numbers, array]] = {}

        def flush():
            for lang, (local, numbers) in held.items():
                ids = np.frombuffer(numbers, np.int32)
                places = np.flatnonzero(ids != local[END]).astype(np.int32)
                tag = lang.encode()
                block = Block(np.array([_key(tag, w, seed) for w in local], np.int64), places, ids[places], places, 1).kept(frequent.value)
                if isinstance(frequent.value, Groups):
                    block.keys = _numbered(block.keys, frequent.value)
                yield block
            held.clear()

        def blocks():
            size = 0
            for batch in batches:
                for lang, words in _languages(batch):
                    local, numbers = held.setdefault(lang, (_Numbers(), array("i")))
                    numbers.extend(map(local.__getitem__, words))
                    numbers.append(local[END])
                    size += len(words) + 1
                    if size >= block_words:
                        yield from flush()
                        size = 0
            yield from flush()

        return _rows(blocks())

    return docs.select("lang", "text").mapInArrow(build, RELATION)


def _counted(relation: DataFrame, columns: list[str], least: int, numbered: bool) -> DataFrame:
    """The merge join and the group count: phrases one word longer than the relation's, found `least` times or more.

    Numbers of words are under 2^31, so two of them travel as one long.
    """
    sent = [f"p{i}" for i in range(0, len(columns), 2)] if numbered else columns

    def count(batches):
        for block in _read(batches):
            longer = block.extended()
            if len(longer.starts):
                keys, group = longer.groups()
                if numbered:
                    keys = [(keys[i] << 32) + keys[i + 1] if i + 1 < len(keys) else keys[i] for i in range(0, len(keys), 2)]
                yield pa.RecordBatch.from_arrays([*(pa.array(k) for k in keys), pa.array(np.bincount(group))], [*sent, "n"])

    parts = relation.mapInArrow(count, ", ".join(f"{c} long" for c in [*sent, "n"]))
    found = parts.groupBy(*sent).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    if numbered:
        pairs = [w for i, p in enumerate(sent) for w in ([F.shiftright(p, 32), F.col(p).bitwiseAND(F.lit((1 << 32) - 1))] if 2 * i + 1 < len(columns) else [F.col(p)])]
        found = found.select(*(w.alias(c) for w, c in zip(pairs, columns)), "n")
    return stored(found, "frequent")


def _shared(groups: DataFrame, columns: list[str], most: int):
    """A broadcast of Groups, or of their Sieve if there are more than `most`."""
    count = groups.count()
    if count > most:
        return groups.sparkSession.sparkContext.broadcast(Sieve.of(groups, columns, count))
    table = groups.select(*columns).toArrow()
    return groups.sparkSession.sparkContext.broadcast(Groups([table.column(c).to_numpy() for c in columns]))


def _semi_joined(relation: DataFrame, groups: DataFrame, columns: list[str], most: int) -> DataFrame:
    """The semi-join: the relation one word longer, with the occurrences of frequent groups; of others, those that a Sieve lets through."""
    held = _shared(groups, columns, most)

    def keep(batches):
        return _rows(block.extended().kept(held.value) for block in _read(batches))

    return stored(relation.mapInArrow(keep, RELATION), "relation")


def frequent_phrases(docs: DataFrame, least: int = 30, block_words: int = 1 << 18, most_shared: int = 2_000_000) -> tuple[DataFrame, list[DataFrame]]:
    """((lang, word, w, n), [of each length from 1 to 4: w1 ... wk, n]): all words, and the phrases found `least` times or more.

    w1 ... wk stand for words as w does for those found `least` times or more.
    """
    spark = docs.sparkSession
    with arrow_batches(spark), lean_disk(spark):
        return _frequent(spark, docs, least, block_words, most_shared)


def _frequent(spark, docs: DataFrame, least: int, block_words: int, most_shared: int) -> tuple[DataFrame, list[DataFrame]]:
    words, seed = vocabulary(docs)
    held = _shared(words.where(F.col("n") >= least), ["w"], most_shared)
    numbered = isinstance(held.value, Groups)
    relation = stored(_built(docs, seed, block_words, held), "relation")
    if numbered:
        hashed = words
        words = stored(hashed.mapInArrow(lambda batches: (b.set_column(2, "w", pa.array(_numbered(b.column(2).to_numpy(), held.value))) for b in batches), hashed.schema), "words")
        discard(spark, hashed)
    frequent = [words.where(F.col("n") >= least).select(F.col("w").alias("w1"), "n")]
    for k in range(2, LONGEST + 1):
        columns = [f"w{i}" for i in range(1, k + 1)]
        frequent.append(_counted(relation, columns, least, numbered))
        before = relation
        if k < LONGEST:
            relation = _semi_joined(before, frequent[-1], columns, most_shared)
        discard(spark, before)
    return words, frequent


def _part(groups: DataFrame, start: int, stop: int, name: str) -> tuple[DataFrame, list[Column]]:
    """The counts of words `start` to `stop` (from 0) of a phrase as `name`, and the condition that joins them to it."""
    own = [f"_{name}{i}" for i in range(stop - start)]
    renamed = groups.select(*(F.col(f"w{i + 1}").alias(o) for i, o in enumerate(own)), F.col("n").alias(name))
    return renamed, [F.col(f"w{start + i + 1}") == F.col(o) for i, o in enumerate(own)]


def _scored(frequent: list[DataFrame], k: int) -> DataFrame:
    """Phrases of k words with a, and l, r and score of the cut that scores lowest, the shortest first part of equal ones."""
    out = frequent[k - 1].withColumnRenamed("n", "a")
    cuts = []
    for c in range(1, k):
        for start, stop, name in ((0, c, f"l{c}"), (c, k, f"r{c}")):
            side, on = _part(frequent[stop - start - 1], start, stop, name)
            out = out.join(side, on).drop(*(x for x in side.columns if x != name))
        score = F.expr(f"cast(a as decimal(30, 0)) * 2000000 div (l{c} + r{c})")
        cuts.append(F.struct(score.alias("score"), F.lit(c).alias("cut"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")))
    best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return out.select(*(f"w{i}" for i in range(1, k + 1)), "a", best.alias("b")).select("*", "b.l", "b.r", "b.score").drop("b")


def _covered(frequent: list[DataFrame], k: int) -> DataFrame | None:
    """(c1 ... ck, longest_n): phrases of k words that lie in longer frequent ones, with the count of the most frequent of these."""
    inside = []
    for m in range(k + 1, LONGEST + 1):
        each = F.array(*(F.struct(*(F.col(f"w{s + i + 1}").alias(f"c{i + 1}") for i in range(k))) for s in range(m - k + 1)))
        inside.append(frequent[m - 1].select(F.explode(each).alias("c"), "n").select("c.*", "n"))
    if not inside:
        return None
    return reduce(DataFrame.unionByName, inside).groupBy(*(f"c{i}" for i in range(1, k + 1))).agg(F.max("n").alias("longest_n"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, block_words: int = 1 << 18, most_shared: int = 2_000_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language.

    Candidates are phrases of 2 to 4 words found `least` times or more; the score of one is floor(2000000 a / (l + r)) of its
    worst cut. Those that lie in a longer candidate with 80 of 100 of their occurrences or more are left out. Ranks go by
    score, a (both descending) and phrase; a language's phrases are ranked in parts, of which the first `top` meet in one task.
    """
    spark = docs.sparkSession
    words, frequent = frequent_phrases(docs, least, block_words, most_shared)
    spelled = words.where(F.col("n") >= least).select("lang", "word", "w")
    chosen = []
    for k in range(2, LONGEST + 1):
        rows = _scored(frequent, k)
        covering = _covered(frequent, k)
        if covering is not None:
            met = rows.join(covering, [F.col(f"w{i}") == F.col(f"c{i}") for i in range(1, k + 1)], "left")
            rows = met.where(~F.coalesce(100 * F.col("longest_n").cast("decimal(30,0)") >= 80 * F.col("a").cast("decimal(30,0)"), F.lit(False)))
        for i in range(1, k + 1):
            side = spelled.select(F.col("w").alias("_w"), F.col("word").alias(f"s{i}"), *(["lang"] if i == 1 else []))
            rows = rows.join(side, F.col(f"w{i}") == F.col("_w")).drop("_w")
        chosen.append(rows.select("lang", F.concat_ws(" ", *(f"s{i}" for i in range(1, k + 1))).alias("phrase"), "a", "l", "r", "score"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = reduce(DataFrame.unionByName, chosen).withColumn("_r", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("_r") <= top).drop("_r")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = words.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("n"))
    out = ranked.join(totals, F.col("lang") == F.col("of"))
    out = out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
    with lean_disk(spark):
        out = stored(out, "ranked")
    for done in (words, *frequent[1:]):
        discard(spark, done)
    return out
