"""Conversation structure repair: the cheapest edits that make the roles legal, by a rank-convergence parallel Viterbi.

A conversation is legal if the initials of its roles read `(s?(ua)+)?`. Rows are kept (K, cost 0), given the role user or assistant
(R, 2) or deleted (D, 3; blank and repeated rows must be); rows without text are inserted (I, 2); a truncated row that stays adds 1.
The audit names the edits in order; of the cheapest ones the least in ASCII is taken.

Conversations are sorted by range over all tasks and cut into chunks of bounded rows, so a long one is many chunks. Costs run backward
through four states. All chunks but a conversation's last start from a speculative vector; a chunk runs again while the vector
that its successor gives differs from the one it used by more than a constant. Constants do not change decisions: costs are the
sum of the chunks', and the edits follow forward from the state in which a chunk is entered.

Null roles and texts count as one space, null turns come first, equal turns go by role and text. Rows without conv_id are one
conversation. Empty and long texts are texts; a chunk ends after `chunk_rows` rows or `chunk_chars` characters. Repeated rows are
rows: all but the first are deleted. An empty table gives an empty one. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelrank.llm.common import discard, stored

#: States by what the roles so far end with: nothing, s, u, a. What a role's initial, or an inserted or renamed row, leads to.
AFTER = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
NEXT = (2, 2, 3, 2)
#: Costs to end in each state: insert what is missing.
END = (0, 4, 2, 0)
INITIALS = "sua-"
FORCED, CUT = 4, 8  # flags of a row's code beside its initial
_SPACE = "\x20\x09-\x0d"
_LAST = re.compile(rf"[^{_SPACE}](?=[{_SPACE}]*\Z)")


def backward(codes: bytes, vector) -> list[tuple[int, int, int, int]]:
    """Costs to the end from each state before each row, and, last, `vector`: the costs after the rows."""
    out = [tuple(vector)]
    for code in reversed(codes):
        b = out[-1]
        keep, late = AFTER.get(INITIALS[code & 3], (None,) * 4), 1 if code & CUT else 0
        costs = []
        for s in range(4):
            c = b[s] + 3
            if not code & FORCED:
                if keep[s] is not None:
                    c = min(c, b[keep[s]] + late)
                c = min(c, b[NEXT[s]] + 2 + late)
            costs.append(c)
        u, a = min(costs[2], costs[3] + 2), min(costs[3], costs[2] + 2)
        out.append((min(costs[0], u + 2), min(costs[1], u + 2), u, a))
    return out[::-1]


def trace(codes: bytes, costs: list[tuple[int, int, int, int]], state: int, last: bool) -> tuple[str, int]:
    """(the least cheapest audit from `state`, the state after the rows); after the last chunk missing rows are inserted."""
    audit, i = [], 0
    while True:
        b = costs[i][state]
        if i < len(codes):
            code, after = codes[i], costs[i + 1]
            late = 1 if code & CUT else 0
            if b == after[state] + 3:
                audit.append("D")
                i += 1
                continue
            if b == costs[i][NEXT[state]] + 2:
                audit.append("I")
                state = NEXT[state]
                continue
            kept = AFTER.get(INITIALS[code & 3], (None,) * 4)[state]
            if kept is not None and not code & FORCED and b == after[kept] + late:
                audit.append("K")
                state = kept
            else:
                audit.append("R")
                state = NEXT[state]
            i += 1
        elif last and state not in (0, 3):
            audit.append("I")
            state = NEXT[state]
        else:
            return "".join(audit), state


def repaired(audit: str, rows: list[tuple[str, str]], state: int) -> list[str]:
    """`role:text` of the rows that an audit leaves, from the state it began in."""
    out, at = [], 0
    named = {2: "user", 3: "assistant"}
    for edit in audit:
        role, text = rows[at] if edit != "I" else ("", "")
        at += edit != "I"
        if edit == "D":
            continue
        state = AFTER[role[:1]][state] if edit == "K" else NEXT[state]
        out.append(f"{role if edit == 'K' else named[state]}:{text}")
    return out


#: Inside, ids and turns are text: pandas would make numbers with nulls inexact.
_CHUNKS = "conv_id string, no long, roles array<string>, texts array<string>, keys array<binary>, turn_first string, turn_last string, turns long"
_CODED = "conv_id string, no long, nx long, before long, turn_first string, turn_last string, turns long, codes binary, blank long, duplicate long, truncated long, illegal long, initial_first string, initial_last string"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _chunked(turns: DataFrame, chunk_rows: int, chunk_chars: int) -> DataFrame:
    """conv_id, no (increasing in a conversation), roles, texts, keys (digests of role and text), and the turns in it."""
    rows = turns.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")
    keyed = dealt.select("conv_id", F.col("turn").cast("string").alias("turn"), "role", "text", F.unhex(F.substring(F.sha2(F.concat_ws("\n", "role", "text"), 256), 1, 32)).alias("key"))

    def cut(batches):
        from pyspark import TaskContext

        no = TaskContext.get().partitionId() << 32
        held: list = []
        chars = 0

        def flush():
            nonlocal no
            known = [r.turn for r in held if r.turn is not None]
            no += 1
            return pd.DataFrame([(held[0].conv_id, no, [r.role for r in held], [r.text for r in held], [r.key for r in held], known[0] if known else None, known[-1] if known else None, len(set(known)))], columns=_names(_CHUNKS))

        for batch in batches:
            for r in batch.itertuples(index=False):
                if held:
                    if r.conv_id != held[0].conv_id or len(held) >= chunk_rows or chars >= chunk_chars:
                        yield flush()
                        held, chars = [], 0
                held.append(r)
                chars += len(r.text)
        if held:
            yield flush()

    return stored(keyed.mapInPandas(cut, _CHUNKS), "chunks")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _coded(chunks: DataFrame) -> DataFrame:
    """Each chunk with its place in the conversation and its rows' codes, without texts; faults are counted."""
    w = Window.partitionBy("conv_id").orderBy("no")
    placed = chunks.select("conv_id", "no").select("conv_id", "no", F.lead("no").over(w).alias("nx"), F.lag("no").over(w).alias("before"))
    placed = stored(placed.where("nx is not null or before is not null"), "placed")  # of conversations of several chunks
    links = placed.select(F.col("conv_id").alias("of"), F.col("no").alias("at"), "nx", "before")
    several = chunks.join(links, _same("conv_id", "of") & (F.col("no") == F.col("at")), "left_semi")
    keys = several.select("conv_id", "no", F.explode(F.array_distinct("keys")).alias("key"))
    first = keys.groupBy("conv_id", "key").agg(F.min("no").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = first.select(F.col("conv_id").alias("of"), F.col("key").alias("k"), "first")
    seen = keys.join(again, _same("conv_id", "of") & (F.col("key") == F.col("k"))).where("no > first").groupBy(F.col("conv_id").alias("seen_of"), F.col("no").alias("seen_at")).agg(F.collect_list("key").alias("seen"))
    rows = chunks.join(links, _same("conv_id", "of") & (F.col("no") == F.col("at")), "left").drop("of", "at").join(seen, _same("conv_id", "seen_of") & (F.col("no") == F.col("seen_at")), "left").drop("seen_of", "seen_at")

    def code(batches):
        for batch in batches:
            codes, counts = [], []
            for r in batch.itertuples(index=False):
                earlier = set() if r.seen is None else {bytes(k) for k in r.seen}
                mine, blank, repeated, cut = bytearray(), 0, 0, 0
                for role, text, key in zip(r.roles, r.texts, r.keys):
                    c = INITIALS.index(role[:1]) if role[:1] in ("s", "u", "a") else 3
                    last = _LAST.search(text[-200:]) or _LAST.search(text)
                    if last is None:
                        blank += 1
                        c |= FORCED
                    elif bytes(key) in earlier:
                        repeated += 1
                        c |= FORCED
                    elif last.group() not in ".!?":
                        cut += 1
                        c |= CUT
                    earlier.add(bytes(key))
                    mine.append(c)
                initials = [INITIALS[c & 3] for c in mine]
                wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
                codes.append(bytes(mine))
                counts.append((blank, repeated, cut, wrong, initials[0], initials[-1]))
            out = batch[["conv_id", "no", "nx", "before", "turn_first", "turn_last", "turns"]].copy()
            out["codes"] = codes
            for i, name in enumerate(("blank", "duplicate", "truncated", "illegal", "initial_first", "initial_last")):
                out[name] = [c[i] for c in counts]
            yield out

    return stored(rows.mapInPandas(code, _CODED), "coded")


def _solved(df: DataFrame) -> DataFrame:
    """Runs the chunks of `df` (with vector) backward: ahead are the costs before a chunk's rows."""

    def run(batches):
        for batch in batches:
            batch = batch.copy()
            batch["ahead"] = [list(backward(c, v)[0]) for c, v in zip(batch["codes"], batch["vector"])]
            yield batch

    return df.select("conv_id", "no", "nx", "codes", "vector").mapInPandas(run, "conv_id string, no long, nx long, codes binary, vector array<long>, ahead array<long>")


def converged(coded: DataFrame) -> tuple[DataFrame, int]:
    """(conv_id, no, vector, ahead of the chunks of conversations with several; passes): vector[0] is 0.

    The first pass starts all chunks at once. A later one runs those whose successor's costs are not parallel to their vector.
    """
    spark = coded.sparkSession
    several = coded.where("nx is not null or before is not null")
    state = stored(_solved(several.withColumn("vector", F.array(*(F.lit(c).cast("long") for c in END)))), "pass1")
    passes = 1
    while True:
        after = state.select(F.col("conv_id").alias("of"), F.col("no").alias("at"), F.transform("ahead", lambda x: x - F.col("ahead")[0]).alias("wanted"))
        met = state.join(after, _same("conv_id", "of") & (F.col("nx") == F.col("at")), "left").drop("of", "at")
        met = met.withColumn("stale", F.coalesce(F.col("wanted") != F.col("vector"), F.lit(False)))
        if not met.where("stale").head(1):
            return state, passes
        passes += 1
        again = _solved(met.where("stale").drop("vector").withColumnRenamed("wanted", "vector"))
        fixed = stored(again.unionByName(met.where("not stale").select(*again.columns)), f"pass{passes}")
        discard(spark, state)
        state = fixed


def _entered(state: DataFrame) -> DataFrame:
    """of, at, vector, entry of the chunks of conversations with several: the state in which a chunk is entered.

    Each chunk is a map of four states to four; a conversation's maps, a few bytes a chunk, are applied in order.
    """

    def maps(batches):
        for batch in batches:
            out = batch[["conv_id", "no", "vector"]].copy()
            out["leads"] = [[trace(c, costs := backward(c, v), s, False)[1] for s in range(4)] for c, v in zip(batch["codes"], batch["vector"])]
            yield out

    made = state.mapInPandas(maps, "conv_id string, no long, vector array<long>, leads array<int>")
    lists = made.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("no", "leads", "vector"))).alias("x"))
    start = F.array(F.lit(0))
    walked = F.aggregate("x", start, lambda states, c: F.concat(states, F.array(c["leads"][F.element_at(states, -1)])))
    return lists.select(F.col("conv_id").alias("of"), F.inline(F.arrays_zip(F.transform("x", lambda c: c["no"]).alias("at"), F.transform("x", lambda c: c["vector"]).alias("vector"), F.slice(walked, 1, F.size("x")).alias("entry")))).toDF("of", "at", "vector", "entry")


def repair_chunks(turns: DataFrame, chunk_rows: int = 2048, chunk_chars: int = 1 << 22) -> DataFrame:
    """Of each chunk, written: conv_id, no, nx, before, counts of faults, cost, audit and lines (`role:text`): a conversation's chunks
    by no make up its repaired turns."""
    spark = turns.sparkSession
    chunks = _chunked(turns, chunk_rows, chunk_chars)
    coded = _coded(chunks)
    state, _ = converged(coded)
    entered = stored(_entered(state), "entered")
    rows = coded.join(entered, _same("conv_id", "of") & (F.col("no") == F.col("at")), "left").drop("of", "at")
    texts = chunks.select(F.col("conv_id").alias("of"), F.col("no").alias("at"), "roles", "texts")
    rows = rows.join(texts, _same("conv_id", "of") & (F.col("no") == F.col("at"))).drop("of", "at")

    def edit(batches):
        for batch in batches:
            made = []
            for r in batch.itertuples(index=False):
                entry, vector = (0, END) if r.vector is None else (int(r.entry), r.vector)
                costs = backward(r.codes, vector)
                audit, _ = trace(r.codes, costs, entry, pd.isna(r.nx))
                made.append((costs[0][0], audit, repaired(audit, list(zip(r.roles, r.texts)), entry)))
            out = batch.drop(columns=["codes", "vector", "entry", "roles", "texts"])
            for i, name in enumerate(("cost", "audit", "lines")):
                out[name] = [m[i] for m in made]
            yield out

    out = rows.mapInPandas(edit, _CODED.replace("codes binary, ", "") + ", cost long, audit string, lines array<string>")
    back = {"conv_id": F.col("conv_id").cast(turns.schema["conv_id"].dataType), **{c: F.col(c).cast("long") for c in ("turn_first", "turn_last")}}
    done = stored(out.withColumns(back), "repaired")
    for table in (chunks, coded, state, entered):
        discard(spark, table)
    return done


def repaired_turns(chunks: DataFrame) -> DataFrame:
    """conv_id, no, pos, role, text: the rows of the repaired conversations, ordered by no and pos."""
    each = chunks.select("conv_id", "no", F.posexplode("lines").alias("pos", "line"))
    return each.select("conv_id", "no", "pos", F.substring_index("line", ":", 1).alias("role"), F.expr("substring(line, instr(line, ':') + 1)").alias("text"))


def report(chunks: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Counts add up over chunks. A conversation of one chunk is hashed in place; the lines of longer ones pass a running hash in
    order, so no task holds more than a batch of them.
    """
    w = Window.partitionBy("conv_id").orderBy("no")
    joint = chunks.drop("lines", "audit").withColumns({
        "across": F.concat(F.lag("initial_last").over(w), F.col("initial_first")),
        "shared": F.coalesce((F.lag("turn_last").over(w) == F.col("turn_first")).cast("long"), F.lit(0)),
    })
    sums = joint.groupBy("conv_id").agg(
        F.coalesce(F.max("turn_last") - F.min("turn_first") + 1 - F.sum(F.col("turns") - F.col("shared")), F.lit(0)).cast("long").alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        (F.sum("illegal") + F.count_if(F.col("across").isNotNull() & ~F.col("across").isin("su", "ua", "au"))).alias("illegal"),
        F.sum("cost").alias("cost"),
    )
    alone = F.col("nx").isNull() & F.col("before").isNull()
    digest = F.sha2(F.array_join("lines", "\n"), 256)
    one = chunks.where(alone).select(F.col("conv_id").alias("of"), "audit", digest.alias("repaired_sha256"))

    def hashed(batches):
        now, running, audit, begun = None, None, [], False

        def row():
            return pd.DataFrame({"of": now, "audit": ["".join(audit)], "repaired_sha256": [running.hexdigest()]})

        for batch in batches:
            for r in batch.itertuples(index=False):
                conv = [r.conv_id]
                if conv != now:
                    if now is not None:
                        yield row()
                    now, running, audit, begun = conv, hashlib.sha256(), [], False
                audit.append(r.audit)
                for line in r.lines:
                    running.update(("\n" + line if begun else line).encode())
                    begun = True
        if now is not None:
            yield row()

    many = chunks.where(~alone).select(F.col("conv_id").cast("string").alias("conv_id"), "no", "audit", "lines").repartition("conv_id").sortWithinPartitions("conv_id", "no")
    long = many.mapInPandas(hashed, "of string, audit string, repaired_sha256 string")
    digests = one.unionByName(long.withColumn("of", F.col("of").cast(chunks.schema["conv_id"].dataType)))
    return sums.join(digests, _same("conv_id", "of")).drop("of")


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with faults planted by the crc32 of `conv_id:turn` modulo 20 (nulls: one space): 0 drops a row, 1 empties its
    text, 2 takes its `.!?` away, 3 repeats it, 4 makes it the user's."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    text = F.when(pick == 1, "").when(pick == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(pick == 4, "user").otherwise(spaced("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(pick == 0, 0).when(pick == 3, 2).otherwise(1)))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_")).drop("_")
