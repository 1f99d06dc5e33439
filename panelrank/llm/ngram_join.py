"""N-gram Jaccard join (operator 8) with adaptive multi-match prefixes.

Texts with 100 * |A & B| >= 80 * |A or B| are linked; A and B are their sets of 5-word shingles. If two sets are
linked, then under any common order of shingles the first n - ceil(0.8 n) + l shingles of both, their l-prefixes,
share at least l shingles, for any l. A longer prefix costs more rows, and asks more of a candidate.

1. Equal sets form a class, by a digest; one member stands for it, so copies are never compared.
2. Under the order of hashes every class shows a prefix with l of a tenth of its size. A class can have a link only
   if enough shingles of its prefix occur in prefixes of other classes. Most classes end here.
3. For the rest Spark counts each shingle's classes, and orders rare ones first. Now each class chooses the l that
   makes its expected candidates fewest: the classes of its prefix's shingles, summed, over l.
4. The classes that show a prefix shingle form a group and are compared with one of them only, that with the smallest
   share of shingles of its own, which joins dense groups at linear cost. Groups that still hold several components
   then give the pairs across components, less those that cannot link by what each shares with the representative. A
   pair that shares as many prefix shingles as the smaller l is verified. So no link between components is lost.
5. No link leaves a component. So that n_links is whole, all pairs inside each component are verified, in tasks of two
   blocks of its classes each.

Verification counts the shingles common to both whole sets. Shingles are compared by 64-bit hashes. Pairs and links
stay in Spark; AQE splits hot shingles and representatives, since written tables stand on both sides of those joins.

Words are lower-cased (A-Z). A text of fewer words than a shingle has its word sequence as its only shingle; null and
blank texts have none and are linked with nothing. Rows with equal ids are separate texts. A null id can be linked; it
is never a component's least id while there is another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.llm.common import stored
from panelrank.llm.components import components
from panelrank.llm.substring_dedup import _A, _D, Chunk, _chunked, _mix

WORDS = 5
#: Similarity as a fraction.
PART, WHOLE = 80, 100
#: Step 2 looks for one in so many of a set's shingles beyond the plain prefix.
EXTRA = 10
#: The largest l that step 3 considers.
MOST = 8
#: Classes of a component that step 5 takes as a block.
BLOCK = 256


def shingle_sets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text; where each text's begin; and a digest of each set (0: empty)."""
    chunk = Chunk(texts, lower=True)
    n = chunk.last - chunk.first
    place = chunk.starts(words)
    value = np.zeros(len(place), np.uint64)
    for j in range(words):
        value = value * _A + (chunk.hash[place + j] if len(place) else value)
    doc = chunk.doc[place]
    short = np.flatnonzero((n > 0) & (n < words))
    extra = np.zeros(len(short), np.uint64)
    for j in range(words - 1):
        more = j < n[short]
        extra[more] = extra[more] * _A + chunk.hash[chunk.first[short[more]] + j]
    value = _mix(np.concatenate([value, _mix(extra + _D * n[short].astype(np.uint64))]))
    doc = np.concatenate([doc, short])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    keep = np.append(True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])) if len(value) else np.zeros(0, bool)
    value, doc = value[keep], doc[keep]
    size = np.bincount(doc, minlength=len(texts))
    begins = np.append(0, np.cumsum(size))
    sums = np.append(np.uint64(0), np.add.accumulate(_mix(value + _D)))
    digest = _mix(sums[begins[1:]] - sums[begins[:-1]] + _A * size.astype(np.uint64))
    digest[size == 0] = 0
    return value, begins, digest


def _need(n):
    """ceil(0.8 n): what a linked set shares at least."""
    return -((-PART * n) // WHOLE)


def _extra(n):
    return np.maximum(1, n // EXTRA)


def _filled(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index("text"), "text", batch.column("text").fill_null(""))


def _prefixes(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest, least (shared shingles needed), prefix (hashes of the prefix in the order of hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunked(_filled(batch), "text"):
                value, begins, digest = shingle_sets(part.column("text").to_pylist())
                n = np.diff(begins)
                length = np.minimum(n, n - _need(n) + _extra(n)) * (n > 0)
                offsets = np.append(0, np.cumsum(length))
                at = np.repeat(begins[:-1] - offsets[:-1], length) + np.arange(offsets[-1])
                prefix = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(value[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(digest.view(np.int64)), pa.array(_extra(_need(n)).astype(np.int32)), prefix], ["doc_id", "n", "digest", "least", "prefix"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, digest long, least int, prefix array<long>")


def _whole_sets(texts: DataFrame) -> DataFrame:
    """digest, n, shingles of the texts that have the digest expected of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunked(_filled(batch), "text"):
                value, begins, digest = shingle_sets(part.column("text").to_pylist())
                good = np.flatnonzero(digest.view(np.int64) == part.column("digest").to_numpy())
                lists = pa.array([value[begins[i] : begins[i + 1]].view(np.int64) for i in good], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)[good]), pa.array(np.diff(begins)[good]), lists], ["digest", "n", "shingles"])

    return texts.select("digest", "text").mapInArrow(run, "digest long, n long, shingles array<long>")


def _adaptive(shared: DataFrame) -> DataFrame:
    """digest, n, alone, l, prefix: the shingles of each class's chosen prefix that other classes have too.

    `shared` has digest, n and `known`, the array of (df, token) of its shingles in two classes or more, rare first.
    The others, `alone` in number, come before them in the order and take their places of the prefix.
    """
    plain = F.col("n") - F.ceil(F.col("n") * PART / WHOLE)
    alone = F.col("n") - F.size("known")
    options = F.filter(F.sequence(F.lit(1), F.lit(MOST)), lambda k: k <= F.ceil(F.col("n") * PART / WHOLE))
    length = lambda k: (plain + k - alone).cast("int")
    total = lambda k: F.aggregate(F.slice("known", 1, length(k)), F.lit(0).cast("double"), lambda acc, x: acc + x["df"])
    cost = F.transform(options, lambda k: F.struct((total(k) / k).alias("cost"), k.alias("l")))
    chosen = shared.where(length(F.lit(1)) >= 1).withColumn("l", F.array_min(cost)["l"])
    return chosen.select("digest", "n", alone.alias("alone"), "l", F.slice("known", 1, length(F.col("l")))["token"].alias("prefix"))


def _may_link(x: str, y: str) -> Column:
    """Whether two classes of one group can have enough in common; x and y end the column names of each.

    `o` is what a class shares with the group's representative. Two classes share at most the smaller of these, and
    of the rest, without the shingles that a class has alone, the smaller again.
    """
    n, o, alone = ([F.col(c + x), F.col(c + y)] for c in ("n", "o", "alone"))
    most = F.least(*o) + F.least(n[0] - alone[0] - o[0], n[1] - alone[1] - o[1])
    return (most * (WHOLE + PART) >= (n[0] + n[1]) * PART) & (F.least(*n) * WHOLE >= F.greatest(*n) * PART)


def _common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of digests with c, the number of shingles common to both whole sets, and whether they are linked."""
    one = sets.select(F.col("digest").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("digest").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    c = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", c.alias("c"), (F.col("na") + F.col("nb")).alias("t"))
    return joined.select("a", "b", "c", (F.col("c") * WHOLE >= (F.col("t") - F.col("c")) * PART).alias("linked"))


def _block_links(group: pa.Table) -> pa.Table:
    """digest, n: links of each class of a block to those of the other block, or of its own."""
    i, j = (group.column(c)[0].as_py() for c in ("i", "j"))
    block, digest, n = (group.column(c).to_numpy() for c in ("block", "digest", "n"))
    shingles = group.column("shingles").combine_chunks()
    flat = np.unique(shingles.flatten().to_numpy(), return_inverse=True)[1]
    begins = np.append(0, np.cumsum(n))
    met = np.zeros(len(flat), bool)
    links = np.zeros(len(n), np.int64)
    for a in np.flatnonzero(block == i):
        own = flat[begins[a] : begins[a + 1]]
        met[own] = True
        common = np.add.reduceat(met[flat].astype(np.int64), begins[:-1])
        met[own] = False
        linked = (common * WHOLE >= (n + n[a] - common) * PART) & (block == j)
        linked[a] = False
        links[a] += linked.sum()
        if i != j:
            links += linked
    return pa.table({"digest": digest, "n": links})


def _links(labels: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """digest, n_links: the number of classes that each class of a component is linked with."""
    sizes = stored(labels.groupBy("label").agg(F.count("*").alias("k")), "sizes")
    sized = stored(labels.join(sizes, "label").select("label", F.col("id").alias("digest"), "k"), "sized")
    several = sized.where("k > 2").join(sets, "digest").withColumn("blocks", F.ceil(F.col("k") / block).cast("int"))
    placed = several.withColumn("block", F.pmod("digest", "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = placed.select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "digest", "n", "shingles")
    counted = dealt.groupBy("label", "i", "j").applyInArrow(_block_links, "digest long, n long").groupBy("digest").agg(F.sum("n").alias("n_links"))
    return stored(sized.where("k = 2").select("digest", F.lit(1).cast("long").alias("n_links")).unionByName(counted), "counted")


def near_duplicates(docs: DataFrame, count_links: bool = True, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (equal shingle sets), n_links (classes that the class is linked with) if `count_links`."""
    parts = stored(_prefixes(docs), "prefixes")
    full = parts.where("n > 0")
    classes = stored(full.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min_by(F.struct("n", "least", "prefix"), F.struct(F.col("doc_id").isNull(), "doc_id")).alias("x")).select("digest", "first", "x.*"), "classes")

    index = classes.select("digest", "least", F.explode("prefix").alias("token"))
    met = stored(index.groupBy("token").agg(F.min("digest").alias("p"), F.max("digest").alias("q")).where("p < q").select("token"), "met")
    hits = index.join(met, "token").groupBy("digest").agg(F.count("*").alias("hits"), F.max("least").alias("least"))
    left = stored(hits.where("hits >= least").select("digest"), "left")

    wanted = classes.select("digest", "first").join(left, "digest")
    ids = docs.select("doc_id", "text").where("text is not null")
    texts = ids.join(wanted, F.col("doc_id").eqNullSafe(F.col("first")))
    sets = stored(_whole_sets(texts).dropDuplicates(["digest"]), "sets")
    tokens = sets.select("digest", "n", F.explode("shingles").alias("token"))
    df = stored(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "df")
    known = tokens.join(df, "token").groupBy("digest").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("known"))
    chosen = stored(_adaptive(known), "adaptive")
    prefix = chosen.select("digest", "n", "alone", F.explode("prefix").alias("token"))

    central = F.struct((F.col("alone") / F.col("n")).alias("by"), "digest")  # most like the others
    leaders = prefix.groupBy("token").agg(F.min(central).alias("x"), F.count("*").alias("k")).where("k > 1")
    leaders = stored(leaders.select("token", F.col("x.digest").alias("a")), "leaders")
    groups = stored(prefix.join(leaders, "token").select("a", F.col("digest").alias("b")).distinct(), "groups")
    stars = stored(_common(groups.where("a <> b"), sets), "stars")
    links = stars.where("linked").select("a", "b")
    labels = components(links)

    info = chosen.select(F.col("digest").alias("b"), "n", "alone")
    named = groups.join(stars.drop("linked"), ["a", "b"], "left").join(info, "b").join(labels, F.col("b") == F.col("id"), "left")
    named = stored(named.select("a", "b", "n", "alone", F.coalesce("c", "n").alias("o"), F.coalesce("label", "b").alias("label")), "members")
    several = stored(named.groupBy("a").agg(F.min("label").alias("p"), F.max("label").alias("q")).where("p < q").select("a"), "several")
    open_ = stored(named.join(several, "a"), "open")
    other = open_.select(F.col("a").alias("a2"), *(F.col(c).alias(f"{c}2") for c in ("b", "n", "alone", "o", "label")))
    across = open_.join(other, (F.col("a") == F.col("a2")) & (F.col("label") != F.col("label2")) & (F.col("b") < F.col("b2")) & _may_link("", "2"))
    pairs = across.where((F.col("a") != F.col("b")) & (F.col("a") != F.col("b2"))).select(F.col("b").alias("x"), F.col("b2").alias("y")).distinct()
    shown = chosen.select(F.col("digest").alias("x"), F.col("l").alias("lx"), F.col("prefix").alias("px"))
    met = pairs.join(shown, "x").join(shown.withColumnsRenamed({"x": "y", "lx": "ly", "px": "py"}), "y")
    enough = met.where(F.size(F.array_intersect("px", "py")) >= F.least("lx", "ly")).select(F.col("x").alias("a"), F.col("y").alias("b"))
    more = stored(_common(enough, sets).where("linked").select("a", "b"), "links")
    every = links.unionByName(more).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    labels = components(every) if more.head(1) else labels

    ends = _links(labels, sets, block) if count_links else labels.select(F.col("id").alias("digest"), F.lit(0).alias("n_links"))
    grouped = classes.join(labels, F.col("digest") == F.col("id"), "left").select("digest", "first", F.coalesce("label", "digest").alias("label"))
    least = stored(grouped.groupBy("label").agg(F.min("first").alias("component_id")), "least")
    named = grouped.join(least, "label").join(ends, "digest", "left")
    named = stored(named.select(F.col("digest").alias("_digest"), F.col("first").alias("class_id"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "named")
    out = parts.join(named, F.col("digest") == F.col("_digest"), "left")
    out = out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )
    return out if count_links else out.drop("n_links")
