"""Collocations against a plain count of all phrases."""

import os
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from panelrank.functions.tables import shared_dir
from panelrank.llm import collocations as C

SCHEMA = "lang string, text string"


def plain(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, 5):
                count.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in able.items():
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            inside = lambda q, p=p: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if not any(inside(q) and 100 * b >= 80 * a for q, b in able.items()):
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def made(n=60, seed=3):
    rng = random.Random(seed)
    words = ["New", "york", "CITY", "of", "the", "é", "É", "a\xa0b", "\xff", "x\x1cy", "zz"]
    texts = []
    for _ in range(n):
        parts = [rng.choice(words) if rng.random() < 0.5 else "new york city" for _ in range(rng.randint(0, 25))]
        texts.append("".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "; "]) for p in parts))
    rows = [(rng.choice(["en", "de", None, "und", ""]), t) for t in texts]
    return rows + rows[:10] + [("en", None), ("fr", ""), (None, None), ("en", " \n. "), ("en", "the of " * 3000)]


@pytest.mark.parametrize("block_words, most_shared", [(1 << 20, 2_000_000), (40, 2_000_000), (40, 0)])
def test_collocations_by_plain_count(spark, block_words, most_shared):
    """Also with blocks of a few words, and with each block joined to its own frequent groups."""
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = sorted(map(tuple, C.collocations(df, 3, 12, block_words, most_shared).collect()))
    assert out == plain(rows, 3, 12) and len(out) > 30


def test_words_have_numbers_of_their_own(spark):
    df = spark.createDataFrame([("en", "one two three four five six seven eight nine ten eleven"), ("de", "one two")], SCHEMA)
    words, seed = C.vocabulary(df)
    assert seed == 0 and words.select("w").distinct().count() == words.count() == 13


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([("en", "a b. a b", 1, "x")], SCHEMA + ", w long, word string")
    assert [tuple(r) for r in C.collocations(df, 2).collect()] == [("en", 1, "a b", 2, 2, 2, 4, 1000000)]
    assert C.collocations(df.where("false"), 2).count() == 0
    assert C.collocations(df, 3).count() == 0


def test_scores_past_64_bits(spark):
    """2000000 a passes 64 bits: the counts of a corpus of 1e13 pairs, scored exactly."""
    a = 10**13 + 7
    f1 = spark.createDataFrame([(1, a + 1), (2, 3 * a)], "w1 long, n long")
    f2 = spark.createDataFrame([(1, 2, a)], "w1 long, w2 long, n long")
    row = C._scored([f1, f2], 2).first()
    assert row["score"] == 2000000 * a // (a + 1 + 3 * a)


def test_words_shared_and_phrases_sieved(spark):
    """More frequent phrases than tasks share, but not more frequent words."""
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    words, frequent = C.frequent_phrases(df, 2, 40)
    most = words.where("n >= 2").count()
    assert most < frequent[1].count()
    assert sorted(map(tuple, C.collocations(df, 2, 12, 40, most).collect())) == plain(rows, 2, 12)


def test_sieve_that_lets_all_through(spark, monkeypatch):
    """What a sieve does not hold back is counted, and is not frequent."""
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(C, "_shared", lambda groups, columns, most: spark.sparkContext.broadcast(C.Sieve(np.full(1 << 16, 255, np.uint8), 19)))
    assert sorted(map(tuple, C.collocations(df, 3, 12, 40).collect())) == plain(rows, 3, 12)


def test_sieve_misses_no_group(spark):
    df = spark.range(40_000).selectExpr("id * 7919 as w1", "id % 97 as w2").repartition(3)
    sieve = C.Sieve.of(df, ["w1", "w2"], 40_000)
    one, two = np.arange(40_000) * 7919, np.arange(40_000) % 97
    assert sieve.have([one, two]).all() and sieve.have([one, two + 1]).mean() < 0.05


@pytest.mark.parametrize("most_shared", [2_000_000, 0])
def test_disk_stays_a_few_times_the_input(spark, tmp_path, monkeypatch, most_shared):
    """Tables and shuffle files after each step, with groups shared and with more groups than are shared."""

    def files():
        tops = [spark.sparkContext.getConf().get("spark.local.dir"), shared_dir(spark)]
        return {os.path.join(d, f) for top in tops for d, _, names in os.walk(top) for f in names}

    rng = np.random.default_rng(5)
    words = np.array([f"{rng.integers(1 << 30):x}" for _ in range(20_000)])
    texts = [(str(i % 2), " ".join(words[np.minimum(rng.zipf(1.25, 300), 20_000) - 1]) + ".") for i in range(3000)]
    spark.createDataFrame(texts, SCHEMA).repartition(8).write.parquet(str(tmp_path / "docs"))
    size = sum(f.stat().st_size for f in (tmp_path / "docs").glob("*.parquet"))
    before, most = files(), []
    stored = C.stored

    def watched(df, label):
        out = stored(df, label)
        time.sleep(0.5)  # files of a shuffle go soon after the job
        most.append(sum(os.path.getsize(f) for f in files() - before if os.path.exists(f)))
        return out

    monkeypatch.setattr(C, "stored", watched)
    assert C.collocations(spark.read.parquet(str(tmp_path / "docs")), 5, 2000, 1 << 14, most_shared).count() > 100
    assert max(most) < 2 * size
