"""Chat formatting (operator 4): conversations to token ids with a loss mask.

Every role name and text is escaped and encoded by itself, so that no token crosses a border and no content can
give a reserved id. The ids of a conversation are then the segments in order with reserved ids spliced between
them; the mask is the prefix sum of +1 at the start and -1 at the end of each trained segment.

Rendered, a reserved id stands for its control string. A control string inside content gets a backslash after
its first character, and a backslash is doubled; `unescape` undoes both exactly.

Turns are ordered by (turn, role, text), nulls first; repeated rows stay repeated turns. A null text is empty, a
null role is the empty role name, a null conversation id is a conversation of its own. A conversation is one row of
the result and must fit in a task, as any format of it must; conversations are spread by their id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm import bpe

#: Control strings of the reserved ids, which follow the vocabulary in this order. Fixed values of the template.
MARKS = {"user": "[INST]", "assistant": "[/INST]", "system": "[SYS]", "role": "[ROLE]", "text": "[/ROLE]", "end": "</s>"}
#: Strings that content must not hold unescaped: the marks, and what similar templates use.
CONTROLS = (*MARKS.values(), "<s>", "[/SYS]", "<|endoftext|>")

_ESCAPE = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROLS)) + r").", re.S)
_UNESCAPE = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def encode_turns(turns: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """conv_id, turn, role, text -> the same with `role_ids` and `ids`, the escaped name and text encoded alone."""
    schema = T.StructType([turns.schema[c] for c in ("conv_id", "turn", "role", "text")] + [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("role_ids", "ids")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, find = bpe.load(ranks_path), bpe.splitter(pattern)
        for batch in batches:
            roles = [coder.encode(escape(x or ""), find) for x in batch.column("role").to_pylist()]
            texts = [coder.encode(escape(x or ""), find) for x in batch.column("text").to_pylist()]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "turn", "role", "text")), pa.array(roles, kind), pa.array(texts, kind)], schema.names)

    return turns.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def _assemble(turns: list[dict], first: int) -> tuple[list[int], np.ndarray]:
    mark = {name: first + i for i, name in enumerate(MARKS)}
    ids: list[int] = []
    steps: list[tuple[int, int]] = []
    for turn in turns:
        role = turn["role"]
        if role in ("user", "assistant", "system"):
            ids.append(mark[role])
        else:
            ids += [mark["role"], *turn["role_ids"], mark["text"]]
        if role == "assistant":
            steps += [(len(ids), 1), (len(ids) + len(turn["ids"]), -1)]
        ids += turn["ids"]
        ids.append(mark["end"])
    change = np.zeros(len(ids) + 1, np.int8)
    for at, by in steps:
        change[at] += by
    return ids, np.cumsum(change[:-1], dtype=np.int8)


def format_conversations(turns: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per conversation: conv_id, n_turns, ids (array of int), loss_mask (array of 0 and 1, as long), text.

    `text` is the rendered form, which holds the same content with control strings for reserved ids.
    """
    grouped = (
        encode_turns(turns, ranks_path, pattern)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "role_ids", "ids"))).alias("turns"))
    )
    schema = T.StructType([grouped.schema["conv_id"], *T._parse_datatype_string("n_turns long, ids array<int>, loss_mask array<tinyint>, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(ranks_path)
        for batch in batches:
            conversations = batch.column("turns").to_pylist()
            made = [_assemble(x, len(coder.entry)) for x in conversations]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array([len(x) for x in conversations], pa.int64()),
                    pa.array([ids for ids, _ in made], pa.list_(pa.int32())),
                    pa.array([mask.tolist() for _, mask in made], pa.list_(pa.int8())),
                    pa.array([render(ids, coder) for ids, _ in made], pa.string()),
                ],
                schema.names,
            )

    return grouped.mapInArrow(run, schema)


def render(ids: list[int], coder: bpe.BytePairs) -> str:
    marks, first = list(MARKS.values()), len(coder.entry)
    return b"".join(coder.entry[i] if i < first else marks[i - first].encode() for i in ids).decode("utf-8")


def parse(ids: list[int], mask: list[int], coder: bpe.BytePairs) -> tuple[list[tuple[str, str]], str]:
    """What the ids say: (role, text) of each turn, and the text under the mask; both unescaped."""
    first, names = len(coder.entry), list(MARKS)
    turns: list[tuple[str, str]] = []
    trained: list[int] = []
    role, role_ids, held = "", [], []
    for i, on in zip(ids, mask):
        if i < first:
            held.append(i)
            if on:
                trained.append(i)
            continue
        name = names[i - first]
        if name == "end":
            turns.append((role, unescape(coder.decode(held).decode("utf-8"))))
        elif name == "text":
            role = unescape(coder.decode(held).decode("utf-8"))
        elif name != "role":
            role = name
        held = []
    return turns, unescape(coder.decode(trained).decode("utf-8"))


def digests(formatted: DataFrame, ranks_path: str) -> DataFrame:
    """Reads formatted conversations back and returns the digests of their turns and of the text under the mask."""
    schema = T.StructType([formatted.schema["conv_id"], *T._parse_datatype_string("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.load(ranks_path)
        for batch in batches:
            rows = []
            for ids, mask, text in zip(*(batch.column(c).to_pylist() for c in ("ids", "loss_mask", "text"))):
                turns, trained = parse(ids, mask, coder)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((len(turns), sha256(said.encode()).hexdigest(), len(trained), sha256(trained.encode()).hexdigest(), len(text), len(ids)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], schema.names)

    return formatted.select("conv_id", "ids", "loss_mask", "text").mapInArrow(run, schema)
