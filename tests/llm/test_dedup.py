"""Line dedup, substring dedup, n-gram join and decontamination on small hand-made tables and against brute force."""

import itertools
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelrank.llm import decontaminate, line_dedup, ngram_join, stages, substring_dedup
from panelrank.llm.components import components

DOCS = "doc_id long, text string, lang string, h long, k int, n long, a string, b string, version string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, "p", "q", "v") for i, t in rows], DOCS)


def words(rng, n, size=500):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def corpus(seed=3):
    """Plain, copied, nearly copied, spliced, empty, null, short and repetitive texts."""
    rng = random.Random(seed)
    base = [words(rng, rng.choice([3, 5, 40, 80, 200, 400])) for _ in range(40)]
    passage = words(rng, 70)
    texts = [" ".join(b) for b in base]
    texts += [texts[4], texts[4], texts[7]]
    for i in (2, 5, 8, 11, 14):
        for changes in (1, 3, 9):
            b = base[i][:]
            for _ in range(changes):
                b[rng.randrange(len(b))] = "changed"
            texts.append(" ".join(b))
    texts += [" ".join(base[9][:20] + passage + base[9][20:]), " ".join(passage), " ".join(passage + base[10]), "same " * 300, "same " * 200, " ".join(["re", "do"] * 150), "", "   \n ", "one", "ONE"]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(1_000, None)]
    rng.shuffle(rows)
    return rows


def split(t, lower=False):
    t = t or ""
    if lower:
        t = t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def test_substring_dedup_brute_force(spark):
    rows = corpus()
    least = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            least[key] = min(least.get(key, i), i)
    want = {}
    for i, t in rows:
        w = split(t)
        gone = {p for k in range(len(w) - 49) if least[tuple(w[k : k + 50])] < i for p in range(k, k + 50)}
        want[i] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    out = substring_dedup.substring_dedup(docs(spark, rows))
    assert set(out.columns) >= {"doc_id", "text", "n_words", "n_removed", "lang"}
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in out.collect()} == want
    assert sum(n for _, n, _ in want.values()) > 500


def test_symbols_are_consistent():
    """A symbol whose reach lies in a window stands in every copy of the window, at the same place."""
    rng = random.Random(1)
    passage = words(rng, 120, 6) + ["z"] * 30 + words(rng, 60)
    names = []
    for _ in range(6):
        before = words(rng, rng.randrange(60), 6)
        chunk = substring_dedup.Chunk([" ".join(before + passage + words(rng, 40, 6))])
        name, start, stop, low, high, _ = chunk.symbols()
        a, b = len(before), len(before) + len(passage)
        names.append({(int(s) - a, int(e) - a, int(x), int(lo) - a, int(hi) - a) for x, s, e, lo, hi in zip(name, start, stop, low, high) if lo >= a and hi <= b})
    assert all(n == names[0] for n in names) and len(names[0]) > 10


def test_ngram_join_brute_force(spark):
    rows = corpus()
    sets = {}
    for i, t in rows:
        w = split(t, True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    want = {i: (len(sets[i]), find(i)) for i in ids}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(spark, rows)).collect()} == want
    assert len({c for _, c in want.values()}) < len(ids) - 8


def test_ngram_join_dense_group(spark):
    """A hundred near copies at varied distances: components as by all pairs."""
    rng = random.Random(5)
    base = words(rng, 60, 10_000)
    rows = []
    for i in range(120):
        b = base[:]
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5])):
            b[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(b)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(56)} for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == label


@pytest.mark.parametrize("block", [7, 256])
def test_ngram_join_counts_every_link(spark, block):
    """n_links by all pairs, also of texts in one component that have their leader in common."""
    rng = random.Random(6)
    rows = []
    for size, copies in ((60, 50), (120, 3), (120, 2)):
        base = words(rng, size, 10_000)
        for _ in range(copies):
            b = base[:]
            b[rng.randrange(size)] = f"x{rng.randrange(9)}"
            if copies == 50 and rng.random() < 0.5:
                b[rng.randrange(size)] = "y"
            rows.append((len(rows), " ".join(b)))
    rows += [(len(rows), rows[0][1]), (len(rows) + 1, " ".join(words(rng, 40, 10_000))), (len(rows) + 2, None)]
    sets = {i: frozenset(tuple(split(t)[k : k + 5]) for k in range(len(split(t)) - 4)) for i, t in rows}
    linked = lambda a, b: a != b and bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    want = {i: sum(linked(a, b) for b in set(sets.values())) for i, a in sets.items()}
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block)
    assert {r.doc_id: r.n_links for r in got.collect()} == want
    assert [want[i] for i in (50, 51, 52)] == [2, 2, 2] and want[53] == want[54] == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 60), (60, 80), (7, 200)]
    out = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.label for r in out.collect()} == {**{i: 0 for i in range(41)}, 200: 0, 60: 60, 80: 60, 100: 60}


def lines(rng, n):
    return [" ".join(words(rng, 6, 2000)) for _ in range(n)]


@pytest.mark.parametrize("coarse", [False, True])
def test_line_dedup(spark, coarse):
    """The first place of each chunk stays; with a hash that takes unequal chunks for equal, bytes decide."""
    rng = random.Random(2)
    block, other = lines(rng, 40), lines(rng, 40)
    rows = [(5, "\n".join(block + other)), (9, "\n".join(lines(rng, 7) + block + lines(rng, 5))), (2, None), (3, ""), (4, "one line"), (6, "one line"), (7, "\n".join(block + other)), (7, "\n".join(block + other)), (8, "\n\n\n\n\n\n\n")]
    extra = {"chunk_hash": lambda c: F.length(c).cast("long") % 3} if coarse else {}
    out = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, rows), **extra).collect()}
    assert out[5].text == rows[0][1] and out[5].n_removed_chunks == 0 and out[5].n_lines == 80
    assert out[2].text is None and out[3].text == "" and out[4].text == out[6].text == "one line"
    assert out[7].text == "" and out[7].n_removed_lines == 80
    kept = out[9].text.split("\n")
    assert 0 < len(kept) < 52 - 20 and [x for x in rows[1][1].split("\n") if x in set(kept)] == kept
    assert set(block) - set(kept) and not set(kept) <= set(block)


@pytest.mark.parametrize("coarse", [False, True])
def test_block_dedup(spark, coarse):
    """Blocks of two to six lines between different neighbours go, and nothing but them."""
    rng = random.Random(12)
    blocks = [lines(rng, n) for n in (2, 3, 4, 5, 6)]
    blocks.append([blocks[0][0] + " more", "", "--", "a line after marks"])
    alone = [(lines(rng, 3), lines(rng, 3)) for _ in range(24)]
    rows = [(i, "\n".join(a + blocks[i % 6] + b)) for i, (a, b) in enumerate(alone)]
    same = "so it goes"
    rows += [(30, "\n".join([same] * 4)), (31, "\n".join([same, same, "end"])), (32, None), (33, "one line"), (34, "\n\n"), (35, "\n".join(blocks[1]))]
    extra = {"pair_hash": lambda c: F.length(c).cast("long") % 3} if coarse else {}
    out = {r.doc_id: r for r in line_dedup.block_dedup(docs(spark, rows), **extra).collect()}
    for i, (a, b) in enumerate(alone):
        assert out[i].text == "\n".join(a + (blocks[i] if i < 6 else []) + b) and out[i].n_removed_lines == (0 if i < 6 else len(blocks[i % 6]))
    assert [out[i].text for i in (30, 31, 32, 33, 34)] == [f"{same}\n{same}", "end", None, "one line", "\n\n"]
    assert out[35].emptied and not any(r.emptied for i, r in out.items() if i != 35)


def test_line_stage_leaves_no_block(spark):
    """The pipeline's stage: no two lines of 10 characters or more stay in a document after the first that has them."""
    rng = random.Random(13)
    blocks = [lines(rng, n) for n in (2, 3, 4, 5, 6)]
    rows = [(i, "\n".join(lines(rng, 4) + blocks[i % 5] + lines(rng, 4)), "en", "s", 7) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = stages.without_repeated_lines(spark, table, "").collect()
    pairs = [p for r in out for p in set(zip(r.text.split("\n"), r.text.split("\n")[1:]))]
    assert len(out) == 40 and len(pairs) == len(set(pairs))
    assert {x for r in out for x in r.text.split("\n")} == {x for r in rows for x in r[1].split("\n")}
    assert all(r.n_chars == len(r.text) for r in out if r.doc_id >= 5)


def test_decontaminate(spark):
    rng = random.Random(4)
    item = words(rng, 20)
    changed = item[:]
    changed[3], changed[9] = "aa", "bb"
    half = item[:6] + words(rng, 14)
    rows = [(1, " ".join(words(rng, 50) + item + words(rng, 9))), (2, " ".join(words(rng, 5) + changed)), (3, " ".join(half)), (4, None), (5, ""), (6, " ".join(item).upper()), (7, " ".join(words(rng, 300))), (None, " ".join(item))]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "too short to tell"), (9, None), (10, " ".join(item[:9]))], "item_id long, text string")
    table = docs(spark, rows)
    leaks = decontaminate.find_leaks(table, bench)
    found = {(r.doc_id, r.item_id, r.start, r.stop) for r in leaks.collect()}
    assert (1, 7, 50, 70) in found and (1, 10, 50, 59) in found
    assert {d for d, *_ in found} == {1, 2, 6, None}
    shuffled = decontaminate.find_leaks(table, bench, broadcast_seeds=0)
    assert {(r.doc_id, r.item_id, r.start, r.stop) for r in shuffled.collect()} == found
    kept = decontaminate.decontaminate(table, bench)
    assert kept.columns == table.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [3, 4, 5, 7]  # the contaminated row of a null id goes too


def test_masks_meet_every_allowed_substitution():
    for length in range(decontaminate.MIN_WORDS, 14):
        masks = decontaminate.MASKS if length == 13 else decontaminate.SHORT_MASKS
        for changed in itertools.combinations(range(length), length - math.ceil(0.8 * length)):
            assert any(not set(changed) & {p + m for m in mask} for mask in masks for p in range(length - max(mask)))


def test_short_items_with_substitutions(spark):
    """Items of 8 to 13 words, each allowed set of substitutions, none more."""
    rng = random.Random(14)
    items = {n: words(rng, n, 10_000) for n in range(8, 14)}
    rows, want = [], set()
    for n, item in items.items():
        most = n - math.ceil(0.8 * n)
        for k in range(most + 2):
            for changed in itertools.islice(itertools.combinations(range(n), k), 60):
                w = [f"z{p}" if p in changed else x for p, x in enumerate(item)]
                rows.append((len(rows), " ".join(words(rng, 3, 10_000) + w + words(rng, 3, 10_000))))
                if k <= most:
                    want.add((rows[-1][0], n))
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in items.items()], "item_id long, text string")
    found = decontaminate.find_leaks(docs(spark, rows), bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and len(want) > 150


CLASHING = ["version", "lines", "starts", "h", "h1", "h2", "_doc", "_h1", "rest", "marks", "gone", "k", "row", "n_words", "key", "item", "seed", "emptied"]


def test_columns_of_any_name_pass_through(spark):
    rng = random.Random(15)
    block = lines(rng, 9)
    rows = [(i, "\n".join(lines(rng, 3) + block + [f"end {i}"])) for i in range(4)] + [(None, None)]
    table = spark.createDataFrame([(*r, *(f"{c} {r[0]}" for c in CLASHING)) for r in rows], ", ".join(["doc_id long", "text string", *(f"`{c}` string" for c in CLASHING)]))
    bench = spark.createDataFrame([(1, block[0])], "item_id long, text string")
    for out, made in (
        (line_dedup.line_dedup(table), {"emptied"}),
        (line_dedup.block_dedup(table), {"emptied"}),
        (substring_dedup.substring_dedup(table, 8), {"n_words"}),
        (decontaminate.decontaminate(table, bench.limit(0)), set()),
    ):
        got = {r.doc_id: r for r in out.collect()}
        assert len(got) == 5
        assert all(r[c] == f"{c} {i}" for i, r in got.items() for c in CLASHING if c not in made)
    assert substring_dedup.substring_dedup(table, 8).where("n_removed > 0").count() == 3


def test_very_long_texts(spark):
    """Megabytes in one line of one word, of many words, and in many lines."""
    rng = random.Random(16)
    many = " ".join(words(rng, 200_000, 5000))
    rows = [(1, "x" * 3_000_000), (2, many), (3, many + " more"), (4, "\n".join(lines(rng, 20_000))), (5, "\n" * 200_000)]
    table = docs(spark, rows)
    cut = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(table).select("doc_id", "n_words", "n_removed").collect()}
    assert cut[2] == (200_000, 0) and cut[3] == (200_001, 200_000) and cut[1] == (1, 0)
    assert {r.doc_id: r.component_id for r in ngram_join.near_duplicates(table).collect()} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5}
    assert line_dedup.block_dedup(line_dedup.line_dedup(table).select("doc_id", "text")).count() == 5
    bench = spark.createDataFrame([(7, " ".join(many.split()[150_000:150_020]))], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.find_leaks(table, bench).collect()} == {2, 3}


def test_rows_that_share_an_id_in_the_stages(spark):
    rng = random.Random(17)
    one, two, three = (" ".join(words(rng, 40, 10_000)) for _ in range(3))
    item = " ".join(words(rng, 20, 10_000))
    rows = [(1, one), (1, one), (3, one), (3, two), (None, two), (4, three), (4, three + " " + item), (None, item), (5, None), (5, None), (6, "")]
    table = spark.createDataFrame([(*r, "en", "s", 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = stages.without_near_copies(spark, table, "")
    key = lambda r: (r.doc_id or 0, r.text or "")
    assert sorted(map(key, left.collect())) == sorted([(1, one), (3, two), (4, three), (4, three + " " + item), (0, item), (5, ""), (6, "")])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = decontaminate.decontaminate(table, bench)
    assert sorted(map(key, clean.collect())) == sorted(map(key, table.where("text is null or not contains(text, '%s')" % item).collect()))
    assert left.columns == clean.columns == table.columns


def test_empty_tables(spark):
    none = docs(spark, []).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.substring_dedup(none).count() == 0
    assert ngram_join.near_duplicates(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0
    assert decontaminate.decontaminate(none, bench).count() == 0
    one = docs(spark, [(1, "a b c d e f g h i j k l m n")])
    assert decontaminate.decontaminate(one, bench).count() == 1


def test_null_and_repeated_ids(spark):
    text = " ".join(words(random.Random(8), 60))
    table = docs(spark, [(None, text), (4, text), (4, text), (4, "other words here"), (None, None)])
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.substring_dedup(table).collect()) == [(0, 0), (0, 0), (4, 0), (4, 0), (4, 0)]
    out = ngram_join.near_duplicates(table).collect()
    assert sorted(r.component_id or 0 for r in out if r.n_shingles) == [4, 4, 4, 4]
    assert line_dedup.line_dedup(table).count() == 5


def test_word_split_is_ascii_white_space_only():
    text = "a\x0bb c\x1cd e\tf\x85g"
    assert [w.decode() for w in substring_dedup.Chunk([text]).words[0]] == split(text)
    assert defaultdict(int) is not None


def test_word_hashes_stand_for_the_bytes_of_words():
    """Equal words have equal hashes wherever they stand, different ones different hashes; words are not made as objects for that."""
    rng = random.Random(5)
    known = ["".join(rng.choices("abé", k=rng.choice((1, 2, 7, 8, 9, 16, 17, 127, 128, 129, 400)))) for _ in range(300)]
    texts = ["".join(w + rng.choice((" ", "\n", "\t\x0b ", "\r\x0c")) for w in rng.choices(known, k=rng.randrange(60))) for _ in range(40)]
    texts += ["", " \n ", known[0], "x" * 8 + " " + "x" * 8 + "\x00", "\x00 \x00\x00"]
    chunk = substring_dedup.Chunk(texts)
    hashes = chunk.hash.tolist()
    assert len(chunk.symbols()[0]) and "words" not in vars(chunk)
    assert (chunk.last - chunk.first).tolist() == [len(w) for w in chunk.words]
    flat = [w for words in chunk.words for w in words]
    meant = dict(zip(flat, hashes))
    assert [meant[w] for w in flat] == hashes and len(set(hashes)) == len(meant)
    alone = substring_dedup.Chunk([w.decode() for w in meant])
    assert alone.hash.tolist() == list(meant.values())
    assert not len(substring_dedup.Chunk([]).hash)
