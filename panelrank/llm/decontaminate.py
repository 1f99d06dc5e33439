"""Benchmark decontamination (operator 2) by spaced seeds. DataFrame functions only.

A mask names token positions inside a short span; the others are ignored. The tokens under a mask are hashed at every
place of every benchmark item and of every document, and equal hashes join. A hit fixes an alignment of one item with
one document. Each alignment is then verified on the words themselves: it is a leak if in some window of `window`
tokens of the item at least `share` of the tokens equal the document's at the same places. An item of 8 to
window - 1 words must match as a whole, with the same share; items under 8 words carry too little to tell and are
ignored. The default mask meets every window of 13 tokens with 2 substitutions anywhere, the most that the default
share allows; two shorter masks do the same for items of 8 to 12 words. So no such overlap is lost.

Words are compared in lower case (A-Z only). Null and empty texts give nothing. Repeated rows of a document and
equal items give a leak each under their ids; a null id is an id like others, and rows that share an id are told apart
by a hash of their text. Masks that no item needs are not looked for. A seed is two numbers, whatever the item's length; the
benchmark's seeds are broadcast only if they number at most `broadcast_seeds` (some 20 bytes each); else both sides are
shuffled by hash, and Spark splits hot hashes. The same holds for hits and for what they condemn: texts are shuffled only
when these are many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.llm.common import lower_ascii, packed, stored, unpacked, words_col

#: Token offsets of each mask. Every choice of two places among 13 leaves one of its shifts untouched.
MASKS = ((0, 1, 3, 6, 7),)
#: The same for items shorter than a window, of 8 words and more, with as many substitutions as a share of 0.8 allows.
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 2, 4))
MIN_WORDS = 8
#: Rows of a few numbers each that may be broadcast.
BROADCAST = 200_000


def _words(text: Column) -> Column:
    return words_col(lower_ascii(text))


def _seeds(table: DataFrame, words: str, masks: dict) -> DataFrame:
    """A row for each mask, by number, and place: the columns of `table` but the words, `mask`, `seed`, and `at`, counted from 0."""
    rest = [c for c in table.columns if c != words]
    hashed = table.select(*rest, F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"))
    out = None
    for number, mask in masks.items():
        span = max(mask) + 1
        places = F.sequence(F.lit(0), F.size("hashes") - span)
        each = F.transform(places, lambda i: F.xxhash64(F.lit(number), *(F.get("hashes", i + m) for m in mask)))  # noqa: B023
        one = hashed.where(F.size("hashes") >= span).select(*rest, F.lit(number).alias("mask"), F.posexplode(each).alias("at", "seed"))
        out = one if out is None else out.unionByName(one)
    return out


def _found(doc: str, item: str, off: str, window: int, share: float) -> Column:
    """Places of the item where a window that matches well enough starts."""
    same = F.transform(item, lambda w, k: F.when(F.coalesce(F.get(doc, k + F.col(off)), F.lit("")) == w, 1).otherwise(0))
    length = F.least(F.size(item), F.lit(window))
    need = F.ceil(length * F.lit(share))
    matches = lambda s, k: F.aggregate(F.slice(s, k + 1, length), F.lit(0), lambda acc, x: acc + x)
    good = lambda s: F.filter(F.sequence(F.lit(0), F.size(item) - length), lambda k: matches(s, k) >= need)
    return F.transform(F.array(same), good)[0]


def _broadcast(written: DataFrame, most: int) -> DataFrame:
    """A written table of some numbers a row, to be broadcast if it has `most` rows at most; else Spark shuffles both sides."""
    return F.broadcast(written) if written.count() <= most else written


def find_leaks(docs: DataFrame, benchmark: DataFrame, masks=MASKS, window: int = 13, share: float = 0.8, broadcast_seeds: int = BROADCAST, short_masks=SHORT_MASKS) -> DataFrame:
    """One row per leak: doc_id, version (hash of the text), item_id, start and stop (document words covered, stop excluded)."""
    items = benchmark.select("item_id", _words(F.col("text")).alias("words")).where(F.size("words") >= MIN_WORDS)
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")
    numbered = dict(enumerate([*masks, *short_masks]))
    long_ones = {k: m for k, m in numbered.items() if k < len(masks)}
    short_ones = {k: m for k, m in numbered.items() if k >= len(masks)}
    short = F.size("words") < window
    item_seeds = _seeds(items.where(~short).select("item", "words"), "words", long_ones).unionByName(_seeds(items.where(short).select("item", "words"), "words", short_ones))
    item_seeds = stored(item_seeds.select("mask", "item", F.col("at").alias("item_at"), "seed"), "seeds")
    used = {r["mask"] for r in item_seeds.select("mask").distinct().collect()}  # a row a mask
    side = item_seeds.select("item", "item_at", "seed")
    side = _broadcast(side, broadcast_seeds)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("version")).where("text is not null")
    seeds = _seeds(texts.select("doc_id", "version", _words(F.col("text")).alias("w")), "w", {k: m for k, m in numbered.items() if k in used or not k})
    hits = seeds.join(side, "seed").select("doc_id", "version", "item", (F.col("at") - F.col("item_at")).alias("off")).distinct()
    hits = stored(hits.withColumnsRenamed({"doc_id": "hit_doc", "version": "hit_version"}), "hits")
    few = _broadcast(hits, broadcast_seeds)
    met = texts.join(few, (F.col("version") == F.col("hit_version")) & F.col("doc_id").eqNullSafe(F.col("hit_doc")))
    joined = met.join(items, "item").select("doc_id", "version", "item_id", "off", "words", _words(F.col("text")).alias("doc"))
    length = F.least(F.size("words"), F.lit(window)).alias("length")
    good = joined.select("doc_id", "version", "item_id", "off", length, _found("doc", "words", "off", window, share).alias("good"))
    return good.where(F.size("good") > 0).select(
        "doc_id", "version", "item_id", (F.col("off") + F.array_min("good")).cast("long").alias("start"), (F.col("off") + F.array_max("good") + F.col("length")).cast("long").alias("stop")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` without a leak, as they were; those with a null or repeated id are decided by id and text."""
    bad = find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias("bad_doc"), F.col("version").alias("bad_version")).distinct()
    bad = _broadcast(stored(bad, "bad"), options.get("broadcast_seeds", BROADCAST))
    mine = packed(docs, ["doc_id", "text"], version=F.xxhash64("text"))
    left = mine.join(bad, (F.col("version") == F.col("bad_version")) & F.col("doc_id").eqNullSafe(F.col("bad_doc")), "left_anti")
    return unpacked(left, {}, ["doc_id", "text"]).select(*(F.col(f"`{c}`") for c in docs.columns))
