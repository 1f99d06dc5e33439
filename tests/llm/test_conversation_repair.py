"""Conversation repair against an exhaustive search and a plain dynamic programme, at chunk sizes that split conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from panelrank.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The report of one conversation's rows (turn, role, text) after damage, by a table of (cost, audit) without chunks."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.search(r"([^\x20\x09-\x0d])[\x20\x09-\x0d]*\Z", text)
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last.group(1) not in ".!?" else "")
        seen.add((role, text))
    n = len(rows)
    best = {}

    def solve(i, s, budget=3):
        """(cost, audit, lines) from state s before row i; at most three insertions in a row can help."""
        if (i, s, budget) in best:
            return best[i, s, budget]
        options = [(0, "", ())] if i == n and s in "-a" else []

        def add(cost, edit, state, line, at, left=3):
            rest = solve(at, state, left)
            options.append((cost + rest[0], edit + rest[1], ((line,) if line is not None else ()) + rest[2]))

        to = "a" if s == "u" else "u"
        if budget:
            add(2, "I", to, {"u": "user:", "a": "assistant:"}[to], i, budget - 1)
        if i < n:
            _, role, text = rows[i]
            add(3, "D", s, None, i + 1)
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                ok = {"s": s == "-", "u": s in "-sa", "a": s == "u"}.get(role[:1], False)
                if ok:
                    add(0 + late, "K", role[0], f"{role}:{text}", i + 1)
                add(2 + late, "R", to, f"{'user' if to == 'u' else 'assistant'}:{text}", i + 1)
        best[i, s, budget] = min(options) if options else (10**9, "", ())
        return best[i, s, budget]

    cost, audit, lines = solve(0, "-") if rows else (0, "", ())
    known = [t for t, _, _ in rows if t is not None]
    ini = [r[:1] if r[:1] in ("s", "u", "a") else "-" for _, r, _ in rows]
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def made(seed, n_conv, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "user", "assistant"]
    texts = ["Yes.", "No", "", " \t", None, "Fine!", "Well?", "é", "a b . ", "Long " * 60 + "end.", "open,", "Go on."]
    rows = []
    for conv in [None, *range(n_conv)]:
        for i in range(rng.randint(1, most)):
            turn = None if rng.random() < 0.1 else i + rng.choice([0, 0, 0, 1, 3])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: plain(r) for conv, r in by.items()}


@pytest.mark.parametrize("chunk_rows", [1, 3, 2048])
def test_repair_by_plain_programme(spark, chunk_rows):
    rows = made(1, 25, 14) + made(2, 25, 14)[14:]  # the second adds rows to the same ids
    chunks = R.repair_chunks(spark.createDataFrame(rows, SCHEMA).repartition(3), chunk_rows)
    found = {r["conv_id"]: r.asDict() for r in R.report(chunks).collect()}
    wanted = expected(rows)
    assert found.keys() == wanted.keys()
    for conv, row in wanted.items():
        assert {k: found[conv][k] for k in row} == row, conv


def test_plain_programme_by_exhaustion():
    """The plain programme against all scripts of up to six edits."""
    pool = [(0, "user", "Hi."), (1, "assistant", "Yes"), (1, "system", "Be."), (2, "tool", "x."), (3, "user", ""), (4, "assistant", "So.")]
    for rows in itertools.chain(*(itertools.combinations(pool, n) for n in (1, 2, 3))):
        got = plain(list(rows))
        options = []
        for length in range(7):
            for script in itertools.product("DIKR", repeat=length):
                state, at, cost, ok = "-", 0, 0, sum(e != "I" for e in script) == len(rows)
                for edit in script if ok else ():
                    to = "a" if state == "u" else "u"
                    if edit == "I":
                        state, cost = to, cost + 2
                        continue
                    _, role, text = rows[at]
                    at += 1
                    if edit == "D":
                        cost += 3
                        continue
                    if not text:
                        ok = False
                        break
                    cost += (2 if edit == "R" else 0) + (text[-1] not in ".!?")
                    if edit == "K" and not (role[0] == "u" and state in "-sa" or role[0] == "a" and state == "u" or role[0] == "s" and state == "-"):
                        ok = False
                        break
                    state = role[0] if edit == "K" else to
                if ok and state in "-a":
                    options.append((cost, "".join(script)))
        assert (got["cost"], got["audit"]) == min(options), rows


def test_passes_end_when_costs_are_parallel(spark):
    """Blank rows only cost a constant, so every chunk before them must wait; legal rows settle the costs in a pass or two."""
    legal = [(1, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(60)]
    cut = legal[:31] + [(1, 31 + i, "user", "") for i in range(20)]
    for rows, most in ((legal, 3), (cut, 9)):
        coded = R._coded(R._chunked(spark.createDataFrame(rows, SCHEMA).coalesce(1), 5, 1 << 20))
        assert R.converged(coded)[1] <= most


def test_texts_come_back(spark):
    rows = [(5, 0, "user", "a:b."), (5, 1, "assistant", "c.\nd."), (9, 0, "assistant", "Only.")]
    chunks = R.repair_chunks(spark.createDataFrame(rows, SCHEMA), 1)
    turns = R.repaired_turns(chunks).orderBy("conv_id", "no", "pos").collect()
    assert [(r["conv_id"], r["role"], r["text"]) for r in turns] == [(5, "user", "a:b."), (5, "assistant", "c.\nd.")] + [(9, "user", ""), (9, "assistant", "Only.")]


def test_large_ids_null_ids_and_extra_columns(spark):
    big = 2**62 + 1
    rows = [(big, 2**61, "user", "Hi.", 1, b"x"), (big, 2**61 + 1, "assistant", "Yes.", 2, b"y"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA + ", no int, lines binary")
    found = {r["conv_id"]: r for r in R.report(R.repair_chunks(df, 1)).collect()}
    assert found[big]["audit"] == "KK" and found[big]["gaps"] == 0 and found[None]["audit"] == "D"
    assert R.report(R.repair_chunks(df.where("false"))).count() == 0


def test_long_texts_cut_chunks(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "word " * 50_000 + f"{i}.") for i in range(6)]
    chunks = R.repair_chunks(spark.createDataFrame(rows, SCHEMA).coalesce(1), chunk_chars=600_000)
    assert chunks.count() == 2 and R.report(chunks).first()["audit"] == "KKKKKK"


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in (None, *range(40)) for t in (None, 0, 1)]
    out = R.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    wanted = []
    for conv, turn, role, text in rows:
        pick = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        row = (conv, turn, "user" if pick == 4 else role, {1: "", 2: "One Two"}.get(pick, text))
        wanted += [row] * {0: 0, 3: 2}.get(pick, 1)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, out), key=key) == sorted(wanted, key=key)
