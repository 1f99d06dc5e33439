"""Toxicity (operator 9): class-conditional Kneser-Ney models of words, spelled by character.

Two models, one of toxic and one of ordinary texts, spell each word from its start, each character given up to
`ORDER - 1` before it in the word. Counts are discounted by modified Kneser-Ney discounts, from the numbers of n-grams
seen once to four times. What a class lacks is filled from its shorter history and from shared counts, those of
both classes together, in equal parts; the shared part always weighs `SHARED` observations at least. An expression
too rare to tell thus says little, and one that a class repeats says much; a rare word still tells by its stem.

The difference of a word's two log-likelihoods is taken along the text. Differences are normalised by length: their
mean over the text, their best means over stretches of a few lengths, that of the two highest, and what stands out over
the root of the length. A logistic regression turns these into a score from 0 to 1.

Counts are numbers of texts that hold a word. The models learn from a bounded sample of labelled rows: at most
`max_docs` of each class, those of the smallest hash of their id. Near copies of one class (equal minima of two hashes over
5-word shingles) count once. A quarter of the sample is kept from the counts and fits the regression; there rows are
weighted, so that each class weighs as it does among all admitted labels and `max_docs` does not move the decision.

Every text is scored whole; words are runs of word characters in lower case, cut every 64 characters. Null and blank
texts, and those without a word character, score as texts without evidence. Repeated rows score alike. Labels other
than 0 and 1 and those of a null id are not learnt from; of several labels of an id the greatest counts. Without
labelled rows of both classes every score is the share of toxic labels, or 0. N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.llm.common import discard, stored

#: Characters of an n-gram, and the observations that the shared part of a smoothed probability weighs at least.
ORDER, SHARED = 6, 2.0
#: Discount of the counts of both classes together.
DISCOUNT = 0.75
#: Lengths of the stretches whose best mean is a feature.
STRETCHES = (1, 5, 20)
#: Weight of the regression's prior, for each 500 rows and at least.
RIDGE = 0.05
#: Shingle length of the near-copy key.
SHINGLE = 5
#: Words that a task counts before it passes them on, words whose difference a worker remembers, and contexts of characters.
HELD_WORDS, WORD_MEMORY, CONTEXT_MEMORY = 100_000, 300_000, 2_000_000
#: Texts and characters handled together.
TOGETHER, CHARS = 200, 1 << 17
START, END = "\x02", "\x03"
_WORD = re.compile(r"\w{1,64}")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _near_key(words: list[str]) -> tuple[int, int]:
    """Minima of two hashes over the shingles of a text."""
    parts = [" ".join(words[i : i + SHINGLE]).encode() for i in range(max(len(words) - SHINGLE + 1, 1))]
    return min(map(zlib.crc32, parts)), min(zlib.crc32(p[::-1], 1) for p in parts)


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Word number and place in its word of each character, the start mark at place 0, and hashes by order of n-grams ending there.

    A hash of order k means something at places from k - 1 on only.
    """
    code = np.frombuffer("".join(f"{START}{w}{END}" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    first = code == ord(START)
    number = np.cumsum(first) - 1
    place = np.arange(len(code)) - np.flatnonzero(first)[number]
    out, key = [], np.zeros(len(code), np.uint64)
    for k in range(ORDER):
        # from the last character back, so that a longer n-gram extends the hash of its suffix
        earlier = code if not k else np.append(np.zeros(min(k, len(code)), np.uint64), code[:-k])
        key = (key ^ (earlier + np.uint64(k + 1))) * _MULTIPLIER
        key = key ^ (key >> np.uint64(29))
        out.append(key)
    return number, place, out


class Table:
    """The n-grams of one order: sorted hashes, counts by class, and, for each as a history, what stands after it."""

    def __init__(self, key: np.ndarray, count: np.ndarray):
        self.key, self.count = key, count
        seen = [np.bincount(np.clip(n, 0, 5), minlength=5)[:5].astype(float) for n in count]
        self.discount = np.stack([_discounts(x) for x in seen])
        self.follow(np.zeros(0, np.int64), count[:, :0], self.discount)

    def follow(self, history: np.ndarray, count: np.ndarray, discount: np.ndarray) -> None:
        """`history`: the place here of the history of each n-gram of the next order; `count` and `discount` are theirs."""
        n = len(self.key)
        self.total = np.stack([np.bincount(history, c, n) for c in count]).astype(np.float32)
        self.freed = np.stack([np.bincount(history, np.minimum(c, d[np.minimum(c, 3)]), n) for c, d in zip(count, discount)]).astype(np.float32)
        self.kinds = np.bincount(history, count.sum(0) > 0, n).astype(np.float32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys; -1 for those not there."""
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        return np.where(self.key[at] == keys, at, -1)


def _discounts(seen: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of the counts 0, 1, 2, and 3 and more, from the numbers of n-grams seen so often."""
    n1, n2, n3, n4 = np.maximum(seen[1:5], 1)
    y = n1 / (n1 + 2 * n2)
    return np.array([0, np.clip(1 - 2 * y * n2 / n1, 0.1, 1), np.clip(2 - 3 * y * n3 / n2, 0.1, 2), np.clip(3 - 4 * y * n4 / n3, 0.1, 3)])


class Contexts:
    """What characters in their contexts say, by the hash of the context; forgotten when there are more than CONTEXT_MEMORY."""

    def __init__(self):
        self.key, self.value = np.zeros(0, np.uint64), np.zeros(0)

    def recall(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each says, and the places of those that are not known."""
        if not len(self.key):
            return np.zeros(len(context)), np.arange(len(context))
        at = np.minimum(np.searchsorted(self.key, context), len(self.key) - 1)
        return self.value[at], np.flatnonzero(self.key[at] != context)

    def learn(self, key: np.ndarray, value: np.ndarray) -> None:
        """Adds sorted keys that are not known yet."""
        if len(self.key) + len(key) > CONTEXT_MEMORY:
            self.key, self.value = key, value
        else:
            at = np.searchsorted(self.key, key)
            self.key, self.value = np.insert(self.key, at, key), np.insert(self.value, at, value)


@dataclass
class Model:
    """The n-grams of both classes, by order from 0 on, and the regression over the means of differences."""

    tables: list[Table]
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def word_differences(self, words: list[str], met: Contexts | None = None) -> np.ndarray:
        """Log-likelihoods of each word, toxic minus ordinary; `met` remembers those of characters between calls."""
        number, place, keys = _grams(words)
        # what stands up to ORDER characters back, from the start of the word on, decides all of a character's n-grams
        context = keys[-1].copy()
        for k in range(ORDER - 1):
            at = np.flatnonzero(place == k)
            context[at] = keys[k][at]
        met = Contexts() if met is None else met
        said, new = met.recall(context)
        if len(new):
            key, first, group = np.unique(context[new], return_index=True, return_inverse=True)
            value = self._differences(new[first], place, keys)
            said[new] = value[group]
            met.learn(key, value)
        return np.bincount(number, said, len(words))

    def _differences(self, i: np.ndarray, place: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        """Log-likelihoods of the characters `i` given those before them, toxic minus ordinary."""
        shared = np.full(len(i), 1 / (len(self.tables[1].key) + 1))
        own = np.stack([shared, shared])
        before = np.maximum(i - 1, 0)
        history = np.where(place[i] > 0, 0, -1)
        for k in range(1, ORDER + 1):
            level, table = self.tables[k - 1], self.tables[k]
            at = np.where(place[i] >= k - 1, table.find(keys[k - 1][i]), -1)
            ok = np.flatnonzero(history >= 0)
            ok = ok[level.kinds[history[ok]] > 0]
            h, x = history[ok], at[ok]
            n = np.where(x >= 0, table.count[:, x], 0)
            total = level.total[:, h]
            p = (np.maximum(n.sum(0) - DISCOUNT, 0) + DISCOUNT * level.kinds[h] * shared[ok]) / total.sum(0)
            kept = np.maximum(n - np.stack([d[np.minimum(c, 3)] for c, d in zip(n, table.discount)]), 0)
            own[:, ok] = (kept + (level.freed[:, h] + SHARED) * 0.5 * (p + own[:, ok])) / (total + SHARED)
            shared[ok] = p
            history = np.where((place[i] > 0) & (place[before] >= k - 1), table.find(keys[k - 1][before]), -1)
        return np.log(own[1]) - np.log(own[0])

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = ((rows - self.mean) / self.scale) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Scorer:
    """Features of texts, with a memory of words."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}
        self.contexts = Contexts()

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(STRETCHES) + 3))
        if len(self.model.tables) > 1:
            lists = list(map(_words, texts))
            self._learn(lists)
            get = self.known.__getitem__
            for row, words in zip(out, lists):
                if words:
                    row[:] = _features(np.fromiter(map(get, words), float, len(words)))
        return out

    def _learn(self, lists: list[list[str]]) -> None:
        new = set().union(*lists) - self.known.keys()
        if len(self.known) + len(new) > WORD_MEMORY:
            self.known.clear()
            new = set().union(*lists)
        new, part = list(new), []
        room = CHARS
        for i, word in enumerate(new):
            part.append(word)
            room -= len(word) + 2
            if room < 0 or i == len(new) - 1:
                self.known.update(zip(part, self.model.word_differences(part, self.contexts).tolist()))
                part, room = [], CHARS


def _features(d: np.ndarray) -> list[float]:
    sums = np.append(0.0, np.cumsum(d))
    best = [(sums[k:] - sums[:-k]).max() / k for k in (min(s, len(d)) for s in STRETCHES)]
    two = np.partition(d, -2)[-2:].mean() if len(d) > 1 else d[0] / 2
    return [d.mean(), *best, two, np.clip(d - 1, 0, 4).sum() / np.sqrt(len(d) + 20)]


def _batches(texts) -> Iterator[list[str | None]]:
    """Texts in lists of at most TOGETHER."""
    for a in range(0, len(texts), TOGETHER):
        yield texts[a : a + TOGETHER]


def _sample(docs: DataFrame, admitted: DataFrame, max_docs: int) -> DataFrame:
    """Labelled texts, one of each group of near copies of a class: doc_id, text, toxic, fold (0 to 3)."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = admitted.where("toxic = 1").orderBy(*order).limit(max_docs).unionByName(admitted.where("toxic = 0").orderBy(*order).limit(max_docs))
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 2 * max_docs ids

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_near_key(_words(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))], [*batch.schema.names, "key", "key2"])

    one = texts.mapInArrow(keyed, "doc_id long, text string, toxic int, key long, key2 long").groupBy("toxic", "key", "key2").agg(F.min(F.struct("doc_id", "text")).alias("x"))
    return one.select("x.*", "toxic", F.pmod(F.col("key"), F.lit(4)).cast("int").alias("fold"))


def _word_counts(sample: DataFrame) -> DataFrame:
    """word, n0, n1: ordinary and toxic texts that hold the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(found)
            out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(found.values()), pa.int64())], ["word", "toxic", "n"])
            found.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found.update((w, toxic) for w in set(_words(text)))
                if len(found) > HELD_WORDS:
                    yield flush()
        yield flush()

    counted = sample.select("text", "toxic").mapInArrow(run, "word string, toxic int, n long")
    return counted.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n1"))


def _gram_counts(words: DataFrame) -> DataFrame:
    """k, key, history, n0, n1: the n-grams of the words by order, with the hash of what comes before the last character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 10_000):
                part = batch.slice(a, 10_000)
                number, place, keys = _grams(part.column("word").to_pylist())
                n = np.stack([part.column(c).to_numpy() for c in ("n0", "n1")])[:, number]
                for k in range(1, ORDER + 1):
                    at = np.flatnonzero(place >= max(k - 1, 1))
                    key, first, group = np.unique(keys[k - 1][at], return_index=True, return_inverse=True)
                    before = keys[k - 2][at[first] - 1] if k > 1 else np.zeros(len(first), np.uint64)
                    sums = [np.bincount(group, c[at], len(key)).astype(np.int64) for c in n]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), k, np.int32)), pa.array(key.view(np.int64)), pa.array(before.view(np.int64)), *map(pa.array, sums)], ["k", "key", "history", "n0", "n1"]
                    )

    grams = words.mapInArrow(run, "k int, key long, history long, n0 long, n1 long")
    return grams.groupBy("k", "key").agg(F.first("history").alias("history"), F.sum("n0").cast("int").alias("n0"), F.sum("n1").cast("int").alias("n1"))


def _tables(of_order) -> list[Table]:
    """The tables by order from 0 on; `of_order` gives the n-grams of an order as columns key, history, n0, n1."""
    start = _grams([""])[2][0][0]
    tables = [Table(np.zeros(1, np.uint64), np.zeros((2, 1), np.int32))]
    for k in range(1, ORDER + 1):
        part = of_order(k)
        key, history = (part[c].to_numpy().view(np.uint64) for c in ("key", "history"))
        count = part[["n0", "n1"]].to_numpy(np.int32).T
        if k == 1:  # the start mark is a history only
            key, history, count = np.append(key, start), np.append(history, np.uint64(0)), np.hstack([count, np.zeros((2, 1), np.int32)])
        order = np.argsort(key)
        tables.append(Table(key[order], np.ascontiguousarray(count[:, order])))
        before = tables[k - 1]
        before.follow(before.find(history[order]) if k > 1 else np.zeros(len(key), np.int64), tables[k].count, tables[k].discount)
    return tables


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, max_docs: int = 10_000) -> Model:
    """Fits the model on labelled rows (doc_id, toxic) for which `may_learn`, a condition on `labels`, holds.

    What reaches the driver, the n-grams of the sampled texts, is bounded by `max_docs` alone.
    """
    spark = docs.sparkSession
    may = F.lit(True) if may_learn is None else may_learn
    admitted = stored(labels.where(may & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "admitted")
    sizes = {r["toxic"]: r["n"] for r in admitted.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    width = len(STRETCHES) + 3
    share = min(max(sizes.get(1, 0) / max(sum(sizes.values()), 1), 1e-13), 1 - 1e-13)
    model = Model([], np.zeros(width), np.ones(width), np.zeros(width), float(np.log(share / (1 - share))))
    if len(sizes) == 2:
        sample = stored(_sample(docs, admitted, max_docs), "sample")
        words = stored(_word_counts(sample.where("fold < 3")), "words")
        grams = stored(_gram_counts(words), "grams")
        if grams.head(1):
            # an order at a time: the driver holds little besides the model
            model.tables = _tables(lambda k: grams.where(F.col("k") == k).select("key", "history", "n0", "n1").toPandas())
            _calibrate(model, sample.where("fold = 3"), share)
        for done in (sample, words, grams):
            discard(spark, done)
    discard(spark, admitted)
    return model


def _calibrate(model: Model, held: DataFrame, share: float) -> None:
    """Fits the regression by Newton steps on the features of the texts kept from the counts; `share`: of toxic labels."""
    shared = held.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "x": [x for texts in _batches(list(batch["text"])) for x in scorer.features(texts)]})

    rows = held.select("text", "toxic").mapInPandas(run, "toxic int, x array<double>").toPandas()  # a quarter of the bounded sample
    shared.destroy()
    y = rows["toxic"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return
    x = np.array(rows["x"].tolist())
    model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.hstack([(x - model.mean) / model.scale, np.ones((len(x), 1))])
    weigh = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    ridge = np.diag([RIDGE * (1 + len(x) / 500)] * x.shape[1] + [1e-6])
    w = np.append(np.zeros(x.shape[1]), model.bias)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weigh * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (weigh * (y - p)) - ridge @ np.append(w[:-1], 0))
        w += np.clip(step, -3, 3)
        if abs(step).max() < 1e-6:
            break
    model.weight, model.bias = w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """The columns of `docs` with the score of `text` in `out` (which replaces a column of that name)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for part in texts:
            rows = [model_score for some in _batches(list(part)) for model_score in shared.value.score(scorer.features(some))]
            yield pd.Series(rows, dtype=float)

    return docs.withColumn(out, scored("text"))
