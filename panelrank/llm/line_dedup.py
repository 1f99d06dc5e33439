r"""Line dedup (operator 1) over content-defined chunks of lines. DataFrame functions only.

Lines end at \n. A rolling hash over the hashes of two lines, mixed by a prime modulus, chooses boundaries: the text is
cut after a line whose value is 0 modulo `divisor`, unless the line before it was chosen too. The choice looks at three
lines only, so a change moves the boundaries next to it and no others, and lines that repeat elsewhere are cut alike. No
chunk has less than two lines, but for texts of one line, which are left alone.

A chunk that occurs more than once, anywhere, stays at its first place, by (doc_id, text hash, position); the others
are removed, once their bytes are found equal. Hashes find the candidates; a hash that stands for different texts
is decided text by text. Rows with equal id and text share one decision. Null texts stay null, empty ones empty.
Columns of any name pass through.

Only hashes and positions are shuffled for the whole table, plus the texts once to compare and once to cut. The
table of repeated hashes is written, so that Spark can split the join at hot chunks.

A repeated block between different neighbours need not hold a whole chunk. `block_dedup` counts every two lines
in a row instead, so no repeated block of two lines or more stays whole beyond its first place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelrank.llm.common import packed, stored, unpacked

#: Multiplier of the rolling hash of 28-bit values, and the prime that mixes it before the divisor sees it.
BASE, PRIME = 65599, 65521
DIVISOR = 2


def _chunks(df: DataFrame, divisor: int, when: Column) -> DataFrame:
    """Adds `lines` and `starts` (places of the first lines of chunks, then the number of lines); null unless `when`."""
    lined = df.withColumn("lines", F.when(when, F.split("text", "\n", -1)))
    valued = lined.withColumn("_v", F.transform("lines", lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long")))
    rolled = valued.withColumn(
        "_c", F.transform("_v", lambda v, i: (i >= 1) & ((v + F.coalesce(F.get("_v", i - 1), F.lit(0)) * BASE) % PRIME % divisor == 0))
    )
    n = F.size("lines")
    places = F.when(n >= 4, F.sequence(F.lit(1), n - 3)).otherwise(F.array().cast("array<int>"))
    cuts = F.filter(places, lambda i: F.get("_c", i) & ~F.get("_c", i - 1))
    starts = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda i: i + 1), F.array(n))
    return rolled.withColumn("starts", F.when(F.col("lines").isNotNull(), starts)).drop("_v", "_c")


def _text_at(k: Column) -> Column:
    first = F.get("starts", k)
    return F.array_join(F.slice("lines", first + 1, F.get("starts", k + 1) - first), "\n")


def _numbers() -> Column:
    return F.sequence(F.lit(0), F.size("starts") - 2)


def line_dedup(docs: DataFrame, divisor: int = DIVISOR, chunk_hash=F.xxhash64) -> DataFrame:
    """The rows of `docs` with `text` cut, and n_lines, n_removed_chunks, n_removed_lines and emptied (which replace columns of these names).

    `emptied` tells that every chunk went. Filter by it, not by the text: a filter on the text would be pushed below
    the columns that it is made of and make them anew for every line.
    """
    key = ["doc_id", "version"]
    place = F.struct("doc_id", "version", "k")
    many = F.instr("text", "\n") > 0
    keyed = packed(docs, ["doc_id", "text"], version=F.xxhash64("text"))
    slim = keyed.select("doc_id", "text", "version")
    cut = _chunks(slim.where(many), divisor, many)
    size = (F.size("starts") - 1).alias("n_chunks")
    chunks = stored(cut.select(*key, size, F.posexplode(F.transform(_numbers(), lambda k: chunk_hash(_text_at(k)))).alias("k", "h")), "chunks")
    repeated = stored(chunks.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n"), "repeated")
    met = chunks.join(repeated, "h").select(*key, "n_chunks", "k", "h", "first")

    # byte comparison: every place of a repeated hash brings its text; equal texts meet before they are shuffled
    marks = met.groupBy(*key).agg(F.collect_set(F.struct("k", "h")).alias("marks")).withColumnsRenamed({"doc_id": "_doc", "version": "_version"})
    same_doc = (F.col("version") == F.col("_version")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    held = _chunks(slim.where(many).join(marks, same_doc), divisor, many).select(*key, "lines", "starts", F.explode("marks").alias("m"))
    texts = held.select(*key, size, F.col("m.k").alias("k"), F.col("m.h").alias("h"), _text_at(F.col("m.k")).alias("chunk"))
    variants = texts.groupBy("h", "chunk").agg(F.count("*").alias("n"))
    clashing = stored(variants.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "clashing")

    flags = met.select(*key, "n_chunks", "k", (F.col("first") != place).alias("removed"), "h")
    if clashing.head(1):
        clashes = stored(texts.join(clashing, "h"), "clashes")
        firsts = clashes.groupBy("h", "chunk").agg(F.min(place).alias("first"))
        exact = clashes.join(firsts, ["h", "chunk"]).select(*key, "n_chunks", "k", (F.col("first") != place).alias("removed"), "h")
        flags = flags.join(clashing, "h", "left_anti").unionByName(exact)
    gone = flags.where("removed").groupBy(*key).agg(F.collect_set("k").alias("gone"), F.max("n_chunks").alias("_all")).withColumnsRenamed({"doc_id": "_doc", "version": "_version"})

    touched = F.col("gone").isNotNull()
    parts = _chunks(keyed.join(gone, same_doc, "left"), divisor, touched)
    kept = F.transform(F.array_except(_numbers(), "gone"), lambda k: _text_at(k))
    lost = F.aggregate("gone", F.lit(0), lambda acc, k: acc + F.get("starts", k + 1) - F.get("starts", k))
    n_lines = F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, 0).otherwise(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)
    made = {
        "n_lines": n_lines.cast("long"),
        "n_removed_chunks": F.when(touched, F.size("gone")).otherwise(0).cast("long"),
        "n_removed_lines": F.when(touched, lost).otherwise(0).cast("long"),
        "emptied": F.coalesce(F.size("gone") == F.col("_all"), F.lit(False)),
    }
    text = F.when(touched, F.array_join(kept, "\n")).otherwise(F.col("text"))
    return unpacked(parts.select("doc_id", text.alias("text"), "rest", *(c.alias(n) for n, c in made.items())), {n: F.col(n) for n in made}, ["doc_id", "text"])


def _contents(df: DataFrame) -> DataFrame:
    """Adds `lines`, and of those that hold a letter or digit the numbers, `at`, and the lines themselves, `content`."""
    # no line is looked up by its number here: pushed into a filter, that would split the text anew for each line
    holds = lambda line: line.rlike(r"[\p{L}\p{N}]")
    lined = df.withColumn("lines", F.split("text", "\n", -1))
    numbers = F.filter(F.transform("lines", lambda x, i: F.when(holds(x), i)), lambda i: i.isNotNull())
    return lined.withColumn("at", numbers).withColumn("content", F.filter("lines", holds))


def block_dedup(docs: DataFrame, pair_hash=F.xxhash64) -> DataFrame:
    """The rows of `docs` with `text` cut, and n_removed_lines and emptied (which replace columns of these names).

    Two lines in a row that occur more than once, anywhere, stay at their first place, by (doc_id, text hash,
    position), and their bytes are compared, as with chunks. Lines without a letter or digit are passed over, and
    go where the lines before and after them go. Any line stays at its first place. `emptied` tells that no
    line with a letter or digit is left; filter by it, not by the text.
    """
    key = ["doc_id", "version"]
    place = F.struct("doc_id", "version", "k")
    many = F.instr("text", "\n") > 0
    keyed = packed(docs, ["doc_id", "text"], version=F.xxhash64("text"))
    slim = keyed.select("doc_id", "text", "version").where(many)
    both = F.zip_with(F.slice("content", 1, F.size("content") - 1), F.slice("content", 2, F.size("content") - 1), lambda x, y: pair_hash(F.concat_ws("\n", x, y)))
    pairs = stored(_contents(slim).select(*key, F.posexplode(F.when(F.size("content") > 1, both)).alias("k", "h")), "pairs")
    repeated = stored(pairs.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n"), "repeated")
    met = pairs.join(repeated, "h").select(*key, "k", "h", "first")

    same_doc = (F.col("version") == F.col("_version")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    named = {"doc_id": "_doc", "version": "_version"}
    marks = met.groupBy(*key).agg(F.collect_set(F.struct("k", "h")).alias("marks")).withColumnsRenamed(named)
    held = _contents(slim.join(marks, same_doc)).select(*key, "content", F.explode("marks").alias("m"))
    texts = held.select(*key, F.col("m.k").alias("k"), F.col("m.h").alias("h"), F.concat_ws("\n", F.get("content", F.col("m.k")), F.get("content", F.col("m.k") + 1)).alias("pair"))
    variants = texts.groupBy("h", "pair").agg(F.count("*").alias("n"))
    clashing = stored(variants.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "clashing")

    flags = met.select(*key, "k", "first", "h")
    if clashing.head(1):
        clashes = stored(texts.join(clashing, "h"), "clashes")
        firsts = clashes.groupBy("h", "pair").agg(F.min(place).alias("first"))
        exact = clashes.join(firsts, ["h", "pair"]).select(*key, "k", "first", "h")
        flags = flags.join(clashing, "h", "left_anti").unionByName(exact)
    # of equal lines in a row the second is the first pair's own
    own = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.version") == F.col("version")) & (F.col("first.k") == F.col("k") - 1)
    lost = F.when(own, F.array(F.col("k") + 1)).otherwise(F.array("k", F.col("k") + 1))
    later = flags.where(F.col("first") != place).select(*key, F.explode(lost).alias("c"))
    gone = later.groupBy(*key).agg(F.sort_array(F.collect_set("c")).alias("gone")).withColumnsRenamed(named)

    touched = F.col("gone").isNotNull()
    joined = keyed.join(gone, same_doc, "left")
    parts = _contents(joined.withColumn("_text", F.col("text")).withColumn("text", F.when(touched, F.col("text"))))
    following = F.concat(F.slice("gone", 2, F.size("gone")), F.array(F.lit(-1)))
    between = F.zip_with("gone", following, lambda c, d: F.sequence(F.get("at", c), F.when(d == c + 1, F.get("at", d)).otherwise(F.get("at", c))))
    parts = parts.withColumn("kept", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.flatten(between)))
    cut = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    made = {
        "n_removed_lines": F.when(touched, F.size("lines") - F.size("kept")).otherwise(0).cast("long"),
        "emptied": F.coalesce(F.size("gone") == F.size("content"), F.lit(False)),
    }
    text = F.when(touched, cut).otherwise(F.col("_text"))
    return unpacked(parts.select("doc_id", text.alias("text"), "rest", *(c.alias(n) for n, c in made.items())), {n: F.col(n) for n in made}, ["doc_id", "text"])
