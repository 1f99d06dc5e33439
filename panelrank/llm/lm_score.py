"""LM scoring (operator 10): a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The first factor is a softmax over classes of words; its
features are the last word, the last two words, and the words two and three places back (skips), hashed to rows of
one weight table. The second is a softmax whose only feature is the word itself, so its weights have a closed form:
the relative frequency inside the class, plus one. Words outside the most frequent `vocabulary` share one class, in
which all words seen, and one place for all unseen, count plus one: so the probabilities of all words sum to 1. Words seen once
are always of that class, so it is learnt whatever the number of words, and its mass is that of new words (Good and Turing). A text
ends with an end token.

Spark counts all tokens of the training texts; what it gathers grows with them. Texts are then written once as ids,
which all later passes read. Classes come from the company that words keep: counts of frequent words among the three
before each, clustered as mixtures. Weights are trained by distributed gradient updates: in each round every task takes
its part of the training texts through mini-batches from the shared weights, and Spark averages each row over the
tasks that changed it; so the weights depend a little on how the input is split. Only the counts of the `vocabulary`
words, the classes and the weights reach the driver, and their sizes are parameters. Counts of rarer words join the
texts' rare words by a shuffle, where no key is frequent.

Null and blank texts have the end token alone. Rows are independent: repeated rows, ids and nulls in other columns
make no difference, and columns may have any names; those of the results are replaced. Texts whose condition is null are
not learnt from. Without training texts nothing is known and every word counts as unseen. Long texts are taken in
stretches of tokens.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.llm.common import discard, packed, stored, unpacked

END = b"\n"
#: Words with an id of their own; frequent words that tell the company; clusters; words that fit the clusters.
VOCABULARY, ANCHORS, CLUSTERS, CLUSTER_WORDS = 100_000, 32, 8, 5_000
#: Ranks that split a cluster into classes by frequency.
BINS = (200, 5_000)
#: Rows of the weight table (16 bits at most), rounds of training, step size and tokens of a mini-batch.
BUCKETS, ROUNDS, STEP, BATCH = 1 << 15, 2, 0.25, 8_192
#: Counted words that a task holds before it passes them on.
HELD_WORDS = 400_000
#: Texts encoded together, and tokens handled together.
TOGETHER, STRETCH = 100, 1 << 17


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8").lower().split(), END]


def count_tokens(texts: DataFrame) -> DataFrame:
    """word (binary), n: occurrences over all texts; the end token is a line feed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(tokens(text))
                if len(seen) > HELD_WORDS:
                    yield flush()
        yield flush()

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """What tasks need to know of the vocabulary; ids are ranks, and the number of words stands for all others."""

    ids: dict[bytes, int]
    count: np.ndarray
    total: int
    distinct: int

    def of(self, text: str | None) -> np.ndarray:
        own = tokens(text)
        return np.fromiter(map(self.ids.get, own, repeat(len(self.ids))), np.int32, len(own))


def encode(docs: DataFrame, words: Words) -> DataFrame:
    """The columns of `docs` without `text`, with ids (of every token), rare (words without an id) and times (how often)."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        no_id, get = len(known.ids), known.ids.get
        for batch in batches:
            for a in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(a, TOGETHER)
                ids, sizes, rare, times, met = [], [0], [], [], [0]
                for value in part.column("text"):
                    own = tokens(value.as_py())
                    one = np.fromiter(map(get, own, repeat(no_id)), np.int32, len(own))
                    ids.append(one)
                    sizes.append(len(one))
                    others = Counter(own[i] for i in np.flatnonzero(one == no_id).tolist())
                    rare += others.keys()
                    times += others.values()
                    met.append(len(rare))
                where = pa.array(np.cumsum(sizes), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(where, pa.array(np.concatenate(ids))),
                    pa.ListArray.from_arrays(pa.array(met, pa.int32()), pa.array(rare, pa.binary())),
                    pa.ListArray.from_arrays(pa.array(met, pa.int32()), pa.array(times, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *lists], [*kept, "ids", "rare", "times"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    return docs.mapInArrow(run, ", ".join([*fields, "ids array<int>", "rare array<binary>", "times array<int>"]))


def _stream(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch's texts in a row, each after three places of -1, and where each of these gaps begins."""
    lists = batch.column("ids")
    sizes = np.diff(lists.offsets.to_numpy())
    starts = np.cumsum(np.append(0, sizes + 3))
    out = np.full(starts[-1], -1, np.int64)
    own = np.ones(len(out), bool)
    for back in range(3):
        own[starts[:-1] + back] = False
    out[own] = lists.flatten().to_numpy(zero_copy_only=False)
    return out, starts[:-1]


def _stretches(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Places of real tokens, their ids and the rows of their features, some tokens at a time."""
    for a in range(3, len(ids), STRETCH):
        part = ids[a - 3 : a + STRETCH]
        real = np.flatnonzero(part[3:] >= 0)
        rows = _features(part)
        for b in range(0, len(real), BATCH):
            at = real[b : b + BATCH]
            yield at + a, part[3:][at], [r[at] for r in rows]


def _company(coded: DataFrame, size: int) -> DataFrame:
    """id, anchor, n: how often each frequent word is among the three words before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size * ANCHORS, np.int64)
        for batch in batches:
            ids, _ = _stream(batch)
            for back in (1, 2, 3):
                near, far = ids[back:], ids[:-back]
                at = np.flatnonzero((far >= 0) & (far < ANCHORS) & (near >= 0) & (near < size))
                np.add.at(found, near[at] * ANCHORS + far[at], 1)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array((at // ANCHORS).astype(np.int32)), pa.array((at % ANCHORS).astype(np.int32)), pa.array(found[at])], ["id", "anchor", "n"])

    return coded.select("ids").mapInArrow(run, "id int, anchor int, n long").groupBy("id", "anchor").agg(F.sum("n").alias("n"))


def _classes(coded: DataFrame, words: Words) -> np.ndarray:
    """Class of each id: cluster by company, split by frequency; then one for the end and one for all other words."""
    size = len(words.ids)
    company = stored(_company(coded, size), "company")
    few = company.where(F.col("id") < CLUSTER_WORDS).toPandas()
    table = np.zeros((min(CLUSTER_WORDS, size), ANCHORS))
    table[few["id"], few["anchor"]] = few["n"]
    background = table.sum(0) + 1.0
    background /= background.sum()
    rows = table / np.maximum(table.sum(1, keepdims=True), 1)
    # the anchors themselves, far apart from each other, start the clusters
    chosen = [0] if size else []
    while size and len(chosen) < min(CLUSTERS, ANCHORS, len(rows)):
        near = np.max([np.sqrt(rows[:ANCHORS]) @ np.sqrt(rows[c]) for c in chosen], axis=0)
        near[chosen] = np.inf
        chosen.append(int(near.argmin()))
    if not chosen:
        discard(coded.sparkSession, company)
        return np.zeros(1, np.int64)
    mix = 0.9 * rows[chosen] + 0.1 * background
    for _ in range(15):
        log = np.log(mix)
        best = (table @ log.T).argmax(1)
        sums = np.stack([table[best == c].sum(0) for c in range(len(mix))])
        mix = 0.98 * (sums + 5 * background) / (sums.sum(1, keepdims=True) + 5) + 0.02 * background
    log = np.log(mix)
    weight = lambda c: F.element_at(F.array(*(F.lit(float(x)) for x in log[c])), F.col("anchor") + 1)
    fits = company.groupBy("id").agg(*(F.sum(F.col("n") * weight(c)).alias(f"c{c}") for c in range(len(mix)))).toPandas()  # a row per word at most
    discard(coded.sparkSession, company)
    cluster = np.zeros(size, np.int64)
    cluster[fits["id"]] = fits[[f"c{c}" for c in range(len(mix))]].to_numpy().argmax(1)
    out = cluster * (len(BINS) + 1) + np.searchsorted(BINS, np.arange(size), side="right")
    top = CLUSTERS * (len(BINS) + 1)
    if END in words.ids:
        out[words.ids[END]] = top
    return np.append(out, top + 1)


def _features(ids: np.ndarray) -> list[np.ndarray]:
    """Rows of the weight table for the token after each three ids; all places from 3 on."""
    one, two, three = ids[2:-1] + 1, ids[1:-2] + 1, ids[:-3] + 1
    spread = lambda x, salt: (((x * 0x9E3779B1 + salt * 0x85EBCA6B) & 0xFFFFFFFFFFFF) * 0x2545F491 >> 17 & (BUCKETS - 1)).astype(np.uint16)
    return [spread(one, 1), spread(two, 2), spread(three, 3), spread(one * 1_000_003 + two, 4)]


def _scores(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Sums of the weights of each token's features and of the general ones, by class; far from overflow."""
    z = weights[rows[0]]
    for r in rows[1:]:
        z += weights[r]
    z += weights[BUCKETS]
    return np.clip(z, -60, 60, out=z)


def _train_round(coded: DataFrame, classes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights after one pass of every task over its texts, averaged by row over the tasks that changed it."""
    spark, n = coded.sparkSession, weights.shape[1]
    shared = spark.sparkContext.broadcast((classes, weights))
    columns = [f"w{c}" for c in range(n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, start = shared.value
        own = start.copy()
        square = np.ones_like(own)
        touched = np.zeros(len(own), bool)
        for batch in batches:
            for _, words, part in _stretches(_stream(batch)[0]):
                error = _scores(own, part)
                np.exp(error, out=error)
                error /= error.sum(1, keepdims=True)
                error[np.arange(len(words)), kind[words]] -= 1
                # sum the errors of equal rows, then one step for each weight, smaller the more it has moved
                flat = np.concatenate(part)
                order = np.argsort(flat, kind="stable")
                first = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0))
                row = flat[order[first]].astype(np.int64)
                change = np.add.reduceat(error[order % len(words)], first, axis=0)
                row, change = np.append(row, BUCKETS), np.vstack([change, error.sum(0)])
                moved = square[row] + np.square(change)
                own[row] -= STEP * change / np.sqrt(moved)
                square[row] = moved
                touched[row] = True
        at = np.flatnonzero(touched)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(own[at, c]) for c in range(n))], ["row", *columns])

    schema = "row int, " + ", ".join(f"{c} float" for c in columns)
    new = coded.select("ids").mapInArrow(run, schema).groupBy("row").agg(*(F.avg(c).cast("float").alias(c) for c in columns)).toPandas()
    shared.unpersist()
    out = weights.copy()
    out[new["row"]] = new[columns].to_numpy(np.float32)
    return out


@dataclass
class Model:
    words: Words
    classes: np.ndarray
    weights: np.ndarray
    in_class: np.ndarray  # by id: log10 of the share in its class; the last is the divisor of the rare class
    counts: DataFrame  # word, n of the words without an id


def _vocabulary(counts: DataFrame, vocabulary: int) -> tuple[Words, DataFrame]:
    """The most frequent words seen twice or more, about `vocabulary` of them, and the counts of all others.

    Words seen once never have an id, so the class of all other words is learnt at every size: from where words that are new
    to the texts before them stand. Frequencies are taken in steps of an eighth of an octave; of the step that is too large, words of the least hashes.
    """
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    step = F.floor(F.log2("n") * 8).cast("int")
    several = counts.where("n > 1")
    steps = sorted(several.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["s"])
    held, frequent = 0, F.lit(False)
    for r in steps:
        if held + r["n"] > vocabulary:
            share = int((vocabulary - held) / r["n"] * (1 << 20))
            frequent = frequent | ((F.col("n") > 1) & (step == r["s"]) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < share))
            break
        held += r["n"]
        frequent = (F.col("n") > 1) & (step >= r["s"])
    top = counts.where(frequent).toPandas().sort_values(["n", "word"], ascending=[False, True])
    words = Words({bytes(w): i for i, w in enumerate(top["word"])}, top["n"].to_numpy(np.int64), int(sums["n"]), int(sums["v"]))
    return words, counts.where(~frequent)


def _learnt(coded: DataFrame, words: Words, others: DataFrame, rounds: int) -> Model:
    """The model from the training texts' ids; each text has its turn in one round."""
    classes = _classes(coded, words)
    weights = np.zeros((BUCKETS + 1, CLUSTERS * (len(BINS) + 1) + 2), np.float32)
    # the general weights start from the classes' shares, so a class that no text shows is unlikely, not open
    shown = np.bincount(classes, np.append(words.count, words.total - words.count.sum()), weights.shape[1]) + 1.0
    weights[BUCKETS] = np.log(shown / shown.sum())
    part = F.pmod(F.xxhash64("ids"), F.lit(rounds))
    for number in range(rounds if len(words.ids) else 0):
        weights = _train_round(coded.where(part == number), classes, weights)
    n = words.count + 1.0
    in_class = np.log10(n / np.bincount(classes[:-1], n, weights.shape[1])[classes[:-1]]) if len(n) else np.zeros(0)
    rare = words.total - int(words.count.sum()) + words.distinct - len(words.ids) + 1
    return Model(words, classes, weights, np.append(in_class, math.log10(rare)), others)


def fit(docs: DataFrame, learn: Column, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> Model:
    """The model of the texts for which `learn`, a condition on `docs`, holds."""
    texts = docs.where(F.coalesce(learn, F.lit(False))).select("text")
    words, others = _vocabulary(stored(count_tokens(texts), "counts"), vocabulary)
    coded = stored(encode(texts, words), "coded")
    model = _learnt(coded, words, others, rounds)
    discard(docs.sparkSession, coded)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of `docs` without `text`, with n_tokens, n_known, train_tokens, base_score and score."""
    return _scored(stored(encode(packed(docs, ["text"]), model.words).withColumn("row", F.monotonically_increasing_id()), "coded"), model)


def fit_and_score(docs: DataFrame, learn: Column, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """The same as `score(docs, fit(docs, learn))`, with every text encoded once."""
    marked = packed(docs, ["text"], learn=F.coalesce(learn, F.lit(False)))
    words, others = _vocabulary(stored(count_tokens(marked.where("learn")), "counts"), vocabulary)
    coded = stored(encode(marked, words).withColumn("row", F.monotonically_increasing_id()), "coded")
    return _scored(coded, _learnt(coded.where("learn"), words, others, rounds))


def _scored(coded: DataFrame, model: Model) -> DataFrame:
    spark, words = coded.sparkSession, model.words
    shared = spark.sparkContext.broadcast((words.count, model.classes, model.weights, model.in_class))
    divisor = math.log10(words.total + words.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, kind, weights, in_class = shared.value
        size = len(count)
        log_count = np.append(np.log10(count + 1.0), 0.0)
        word_log = np.append(in_class[:-1], -in_class[-1])
        for batch in batches:
            ids, starts = _stream(batch)
            log = np.zeros(len(ids))
            for at, own, rows in _stretches(ids):
                z = _scores(weights, rows)
                mine = z[np.arange(len(own)), kind[own]]
                log[at] = (mine - np.log(np.exp(z, out=z).sum(1))) / math.log(10) + word_log[own]
            real = ids >= 0
            base = np.where(real, log_count[ids] - divisor, 0.0)
            sums = [np.add.reduceat(x, starts) for x in (real.astype(np.int64), (real & (ids < size)).astype(np.int64), base, log)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, sums)], ["row", "n_tokens", "n_known", "base_score", "score"])

    sums = coded.select("row", "ids").mapInArrow(run, "row long, n_tokens long, n_known long, base_score double, score double")
    rare = coded.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), "x.times")
    met = rare.join(model.counts, "word", "left")
    extra = met.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("more")
    )
    rest = coded.drop("ids", "rare", "times", "learn")
    whole = rest.join(sums, "row").join(extra, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    made = {
        "n_tokens": F.col("n_tokens"),
        "n_known": F.col("n_known") + F.coalesce("more_known", F.lit(0)),
        "train_tokens": F.lit(words.total).cast("long"),
        "base_score": F.col("base_score") + more,
        "score": F.col("score") + more,
    }
    return unpacked(whole, made)
