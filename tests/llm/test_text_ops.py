"""Byte-level BPE, chat formatting, media, URL filters, toxicity and LM scoring."""

import base64
import io
import math
import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelrank.llm import bpe, chat, lm_score, media, queries, toxicity, url_filter
from panelrank.llm.common import table


def rank_encode(text, ranks, find):
    """Plain merging by rank."""
    out = []
    for piece in find(text):
        piece = piece.encode()
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while piece not in ranks and len(parts) > 1:
            rank, i = min((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out += [ranks[piece]] if piece in ranks else [ranks[p] for p in parts]
    return out


@pytest.fixture(scope="module")
def coder():
    path, pattern = queries.tokenizer()
    return bpe.load(path), bpe.splitter(pattern)


def test_bpe_matches_merging_and_library(coder):
    tiktoken = pytest.importorskip("tiktoken")
    c, find = coder
    path, pattern = queries.tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(0)
    parts = ["a", "the", "ing", " ", "  ", "\n", "é", "日本", "😀", "12", "!!", "'s", "ß", "zz", "<|endoftext|>", "\x00"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        ids = c.encode(text, find)
        assert ids == library.encode_ordinary(text) == rank_encode(text, ranks, find)
        assert c.decode(ids).decode() == text
    for text in ("a" * 4000, " " * 3000 + "x", "ab" * 2000, "\n" * 500):
        assert c.encode(text, find) == library.encode_ordinary(text)


def test_bpe_query(spark, sf, coder):
    c, find = coder
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in queries.op7_byte_bpe(spark, sf).collect()}
    for i, text in texts.items():
        ids = c.encode(text, find)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == sha256(text.encode()).hexdigest()


def test_bpe_edges(spark):
    path, pattern = queries.tokenizer()
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "ab", None)], "doc_id long, text string, ids string")
    rows = bpe.decode(bpe.encode(df, path, pattern), path).orderBy("doc_id", "bytes").collect()
    assert [(r.doc_id, list(r.ids), bytes(r.bytes)) for r in rows] == [(1, [], b""), (2, [], b""), (2, [397], b"ab")]
    assert bpe.encode(df.limit(0), path, pattern).count() == 0


def test_escape_is_reversible():
    rng = random.Random(1)
    parts = [*chat.CONTROLS, "\\", "<", "[", "]", "s>", "/", "INST", "a", "\n", "[/", "</"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(c in safe for c in chat.CONTROLS)


def test_chat(spark, coder):
    c, _ = coder
    path, pattern = queries.tokenizer()
    rows = [(1, 0, "system", "be kind"), (1, 2, "assistant", "</s>ok[INST]"), (1, 1, "user", None), (1, 3, "to[ROLE]ol", "x\\y"), (1, 4, "assistant", ""), (2, 0, None, "é"), (2, None, "user", "first"), (None, 0, "user", "lost"), (3, 0, "user", "twin"), (3, 0, "user", "twin")]
    turns = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    out = {r.conv_id: r for r in chat.format_conversations(turns, path, pattern).collect()}
    said, trained = chat.parse(out[1].ids, out[1].loss_mask, c)
    assert said == [("system", "be kind"), ("user", ""), ("assistant", "</s>ok[INST]"), ("to[ROLE]ol", "x\\y"), ("assistant", "")]
    assert trained == "</s>ok[INST]" and len(out[1].ids) == len(out[1].loss_mask)
    assert out[1].text.count("</s>") == 5 and out[1].text.count("[INST]") == 1
    assert chat.parse(out[2].ids, out[2].loss_mask, c)[0] == [("user", "first"), ("", "é")]
    assert out[3].n_turns == 2 and out[None].n_turns == 1
    assert chat.format_conversations(turns.limit(0), path, pattern).count() == 0


def test_media_round_trips():
    rng = np.random.default_rng(0)
    grey, colour = rng.integers(0, 256, (5, 64), np.uint8), rng.integers(0, 256, (3, 4, 3), np.uint8)
    assert (media.decode(media.to_pgm(grey.tobytes())) == grey).all()
    assert (media.decode(media.to_bmp(grey.tobytes())) == grey).all()
    assert (media.decode(b"P6 4 3\n# note\n255\n" + colour.tobytes()) == colour).all()
    assert (media.decode(b"P3\n4 3\n255\n" + b" ".join(str(x).encode() for x in colour.ravel())) == colour).all()
    assert (media.decode(b"P2 2 1 15\n0 15") == [[0, 255]]).all()
    assert (media.decode(b"P1\n3 1\n1 0 1") == [[0, 255, 0]]).all()
    assert (media.decode(b"P4\n3 1\n\xa0") == [[0, 255, 0]]).all()
    for bad in (b"", b"P5 9 9 255\nxx", b"GIF", b"P5", b"BM" + bytes(60)):
        with pytest.raises(Exception):
            media.decode(bad)


def test_area_resize():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (12, 18), np.uint8)
    assert np.allclose(media.area_resize(image, 4, 6), image.reshape(4, 3, 6, 3).mean((1, 3)))
    big = np.kron(image, np.ones((5, 7)))  # any size: exact means of areas that cut through samples
    assert np.allclose(media.area_resize(image, 5, 7), big.reshape(5, 12, 7, 18).mean((1, 3)))
    tall = rng.integers(0, 256, (3 * media.BLOCK_ROWS + 17, 3), np.uint8)
    assert np.allclose(media.area_resize(tall, 1, 3)[0], tall.mean(0))


def test_media_columns(spark):
    df = spark.createDataFrame([(1, "é" * 40, "x"), (2, None, "y"), (3, "", "z"), (4, "é" * 40, None)], "doc_id long, text string, error string")
    stored = media.store_bytes(df, "text")
    rows = {r.doc_id: r for r in media.inspect(stored).collect()}
    for i, text in ((1, "é" * 40), (2, ""), (3, ""), (4, "é" * 40)):
        payload = media.pad(text.encode())
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text.encode()), len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert np.load(io.BytesIO(r.tile)).shape == (16, 16) and len(r.dhash) == 16 and r.error is None
    assert rows[1].dhash == rows[4].dhash and rows[1].media_sha256 == rows[4].media_sha256
    raw = spark.createDataFrame([(1, None), (2, bytearray(b"junk")), (3, bytearray(media.to_bmp(bytes(range(64)))))], "id long, media binary")
    found = {r.id: r for r in media.inspect(raw).collect()}
    assert found[1].error == "empty" and found[2].error and found[2].dhash is None and found[3].payload_bytes == 64
    assert media.inspect(raw.limit(0)).count() == 0


def test_url_filter(spark):
    entries = spark.createDataFrame(
        [("bad.org", "spam", "2024-01-10", "add"), ("bad.org", "spam", "2024-02-10", "remove"), ("x.bad.org", "ads", "2024-01-01", "add"), ("bad.org", "spam", "2024-03-01", "add"), (None, "spam", "2024-01-01", "add"), ("day.org", "s", "2024-01-05", "add"), ("day.org", "s", "2024-01-05", "remove")],
        "domain string, list string, date string, action string",
    )
    urls = [(1, "http://www.bad.org/a", "2024-01-10"), (2, "https://bad.org", "2024-02-10"), (3, "https://u:p@Y.X.bad.org:80/?q", "2024-01-20"), (4, "https://notbad.org", "2024-01-20"), (5, None, "2024-01-20"), (6, "bad.org", "2024-01-20"), (7, "http://bad.org", None), (8, "http://bad.org", "2024-05-01"), (9, "http://day.org", "2024-01-06"), (8, "http://bad.org", "2024-05-01"), (10, "http://bad.org", "2024-01-09")]
    captures = spark.createDataFrame([(*u, "z") for u in urls], "page_id long, url string, fetch_date string, domain string")
    out = url_filter.filter_urls(captures, entries)
    got = sorted((r.page_id, r.matched_domain, r.matched_list, r.n_matches, r.blocked) for r in out.collect())
    blocked = [g for g in got if g[4]]
    assert blocked == [(1, "bad.org", "spam", 1, True), (3, "x.bad.org", "ads", 2, True), (8, "bad.org", "spam", 1, True), (8, "bad.org", "spam", 1, True)]
    assert len(got) == len(urls) and out.where("blocked").count() == 4
    assert url_filter.filter_urls(captures, entries.limit(0)).where("blocked").count() == 0
    assert url_filter.filter_urls(captures.limit(0), entries).count() == 0


def test_hosts_that_are_addresses(spark):
    entries = spark.createDataFrame([("0.1", "ads", "2024-01-01", "add"), ("10.9.0.2", "ads", "2024-01-01", "add"), ("[2001:db8::1]", "ads", "2024-01-01", "add")], "domain string, list string, date string, action string")
    urls = ["http://10.9.0.1/x", "http://10.9.0.2:80/", "http://[2001:DB8::1]:8080/a", "http://u@[2001:db8::2]"]
    captures = spark.createDataFrame([(i, u, "2024-02-01") for i, u in enumerate(urls)], "page_id long, url string, fetch_date string")
    got = {r.page_id: (r.host, r.blocked) for r in url_filter.filter_urls(captures, entries).collect()}
    assert got == {0: ("10.9.0.1", False), 1: ("10.9.0.2", True), 2: ("[2001:db8::1]", True), 3: ("[2001:db8::2]", False)}


def labelled(spark, n=1200, seed=0):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(300)]
    rude = ["vile", "rotten", "scum", "wretch"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = rng.choices(common, k=rng.randrange(20, 120))
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(rude))
        docs.append((i, " ".join(w), "x"))
        labels.append((i, int(toxic)))
    docs += [(n, None, "x"), (n + 1, "", "x"), (n + 1, "vile scum", "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels, ~queries.held_out(4))
    out = toxicity.score(docs, model)
    assert out.columns == docs.columns
    rows = out.join(labels, "doc_id").where(queries.held_out(4)).collect()
    wrong = sum((r.score >= queries.TOXIC) != bool(r.toxic) for r in rows)
    assert len(rows) > 200 and wrong / len(rows) < 0.03
    rest = {r.text: r.score for r in out.where("doc_id >= 1200").collect()}
    assert rest[None] == rest[""] and 0 <= rest[None] < queries.TOXIC <= rest["vile scum"] <= 1


def test_toxicity_on_the_given_tables(spark):
    """Held-out recall, false alarms and order at the middle size, and a flagged share that the sample's bound does not move."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (table(spark, sf, n) for n in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id"), "doc_id").select("doc_id", "text").cache()
    flagged = []
    for most in (10_000, 1_500):
        model = toxicity.fit(docs, labels, ~queries.held_out(4), max_docs=most)
        rows = toxicity.score(docs, model).join(labels, "doc_id").select("score", "toxic", queries.held_out(4).alias("held")).toPandas()
        flagged.append((rows["score"] >= queries.TOXIC).mean())
        held = rows[rows["held"]]
        toxic, ordinary = (held["score"][held["toxic"] == t].to_numpy() for t in (1, 0))
        above = (toxic[:, None] > ordinary[None, :]).mean()
        if most == 10_000:
            assert above > 0.925 and (toxic >= queries.TOXIC).mean() > 0.68 and (ordinary >= queries.TOXIC).mean() < 0.04
    docs.unpersist()
    assert abs(flagged[0] - flagged[1]) < 0.015


def test_toxicity_model_by_brute_force():
    """Differences of words against a plain, recursive reading of the model."""
    rng = random.Random(5)
    counts = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))): (rng.randrange(4), rng.randrange(3)) for _ in range(60)}
    order, frames = toxicity.ORDER, []
    words = list(counts)
    number, place, keys = toxicity._grams(words)
    for k in range(1, order + 1):
        at = np.flatnonzero(place >= max(k - 1, 1))
        before = keys[k - 2][at - 1].view(np.int64) if k > 1 else 0
        n = np.array([counts[words[i]] for i in number[at]])
        frames.append(pd.DataFrame({"k": k, "key": keys[k - 1][at].view(np.int64), "history": before, "n0": n[:, 0], "n1": n[:, 1]}).groupby("key", as_index=False).agg({"k": "first", "history": "first", "n0": "sum", "n1": "sum"}))
    every = pd.concat(frames)
    model = toxicity.Model(toxicity._tables(lambda k: every[every["k"] == k]), np.zeros(6), np.ones(6), np.zeros(6), 0.0)

    grams = Counter()
    for w, (a, b) in counts.items():
        s = toxicity.START + w + toxicity.END
        for i in range(1, len(s)):
            for k in range(1, min(order, i + 1) + 1):
                grams[s[i - k + 1 : i + 1], 0] += a
                grams[s[i - k + 1 : i + 1], 1] += b
    kinds = {g for g, _ in grams}
    following = {h: [g for g in kinds if g[:-1] == h] for h in {g[:-1] for g in kinds}}

    def discount(n, c, k):
        return model.tables[k].discount[c][min(n, 3)]

    def both(g):  # of the shared model
        h = following.get(g[:-1], [])
        total = sum(grams[x, 0] + grams[x, 1] for x in h)
        lower = both(g[1:]) if len(g) > 1 else 1 / (len(model.tables[1].key) + 1)
        if not total:
            return lower
        return (max(grams[g, 0] + grams[g, 1] - 0.75, 0) + 0.75 * sum(grams[x, 0] + grams[x, 1] > 0 for x in h) * lower) / total

    def own(g, c):
        h, k = following.get(g[:-1], []), len(g)
        lower = own(g[1:], c) if k > 1 else 1 / (len(model.tables[1].key) + 1)
        if not sum(grams[x, 0] + grams[x, 1] for x in h):
            return lower
        freed = sum(min(grams[x, c], discount(grams[x, c], c, k)) for x in h)
        return (max(grams[g, c] - discount(grams[g, c], c, k), 0) + (freed + 2) * 0.5 * (both(g) + lower)) / (sum(grams[x, c] for x in h) + 2)

    tests = words[:20] + ["abcabcabcabc", "zzz", "a", "cz"]
    want = []
    for w in tests:
        s = toxicity.START + w + toxicity.END
        at = [s[max(i - order + 1, 0) : i + 1] for i in range(1, len(s))]
        want.append(sum(math.log(own(g, 1) / own(g, 0)) for g in at))
    assert np.allclose(model.word_differences(tests), want, atol=1e-4)


def test_toxicity_contexts_are_looked_up_once(spark, monkeypatch):
    """Contexts that were met are not looked up again, and say the same after other words and after a clearing."""
    model = toxicity.fit(*labelled(spark, 300))
    tests = ["c1", "c17x", "abcabcabcabc", "zzz", "a", "", "c1c1c1"]
    met, looked, find = toxicity.Contexts(), [], toxicity.Table.find
    monkeypatch.setattr(toxicity.Table, "find", lambda table, keys: looked.append(len(keys)) or find(table, keys))
    first = model.word_differences(tests, met)
    asked = sum(looked)
    assert asked and np.array_equal(model.word_differences(tests[::-1] + tests, met), np.append(first[::-1], first)) and sum(looked) == asked
    monkeypatch.setattr(toxicity, "CONTEXT_MEMORY", 5)
    assert np.array_equal(np.concatenate([model.word_differences([w], met) for w in tests]), first)


def test_toxicity_long_texts_and_names(spark):
    docs, labels = labelled(spark, 300)
    model = toxicity.fit(docs, labels)
    texts = [(1, "x" * 2_000_000), (2, "c1 " * 500_000), (3, "!!! ... \n"), (4, None)]
    odd = spark.createDataFrame([(*t, "keep") for t in texts], "doc_id long, text string, `fold` string")
    rows = {r.doc_id: r for r in toxicity.score(odd, model, "mark").collect()}
    assert all(0 <= r.mark <= 1 and r.fold == "keep" for r in rows.values()) and rows[3].mark == rows[4].mark


def test_toxicity_without_labels(spark):
    docs, labels = labelled(spark, 60)
    for some in (labels.limit(0), labels.where("toxic = 1")):
        scores = {r.score for r in toxicity.score(docs, toxicity.fit(docs, some)).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0


def test_lm_base_score_and_gain(spark):
    rng = random.Random(3)
    langs = [[f"{p}{i}" for i in range(60)] for p in "abc"]
    rows = [(i, " ".join(rng.choices(langs[i % 3], weights=range(60, 0, -1), k=rng.randrange(5, 80)))) for i in range(400)] + [(500, None), (501, ""), (501, "Never SEEN words"), (502, "A0 a0\x0bB1"), (503, "a0 a1 " * 90_000)]
    docs = spark.createDataFrame([(i, t, "x", 7, 1.5) for i, t in rows], "doc_id long, text string, word string, more long, row double")
    seen = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            seen.update(lm_score.tokens(t))
    total, distinct = sum(seen.values()), len(seen)
    for vocabulary in (1000, 50):
        one = lm_score.score(docs, lm_score.fit(docs, ~queries.held_out(7), vocabulary=vocabulary))
        out = lm_score.fit_and_score(docs, ~queries.held_out(7), vocabulary=vocabulary).collect()
        key = lambda r: (r.doc_id, r.n_tokens, round(r.base_score, 4))
        for x, y in zip(sorted(one.collect(), key=key), sorted(out, key=key)):
            assert key(x) == key(y) and abs(x.score - y.score) < 0.02 * abs(y.score) and (x.word, x.more, x.row) == ("x", 7, 1.5)
        assert len(out) == len(rows) and one.columns == ["doc_id", "word", "more", "row", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        want = sorted((i, len(lm_score.tokens(t)), sum(seen[w] > 0 for w in lm_score.tokens(t)), round(sum(math.log10((seen[w] + 1) / (total + distinct + 1)) for w in lm_score.tokens(t)), 6)) for i, t in rows)
        assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == want
        assert {r.train_tokens for r in out} == {total}
        held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
        assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.score < 0 for r in out)


def test_lm_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["x y x", "x z", "y y q"] * 4)], "doc_id long, text string")
    model = lm_score.fit(docs, F.lit(True), vocabulary=3)
    vocabulary = {r.word for r in lm_score.count_tokens(docs).collect()} | {b"unseen"}
    words = [w.decode() for w in vocabulary if w != lm_score.END]
    tests = spark.createDataFrame([(0, "x y")] + [(i + 1, f"x y {w}") for i, w in enumerate(words)], "doc_id long, text string")
    # P(text) = P(words) P(end | words); strip the end by comparing with the class and word factors directly
    ids = np.array([-1, -1, -1, *model.words.of("x y")[:2], 0])
    by_class = np.exp(lm_score._scores(model.weights, [r[-1:] for r in lm_score._features(ids)])[0])
    by_class /= by_class.sum()
    inside = np.bincount(model.classes[:-1], 10.0 ** model.in_class[:-1], len(by_class))
    assert np.allclose(inside[inside > 0], 1)
    rare = [w for w in vocabulary if w not in model.words.ids]
    counts = {r.word: r.n for r in model.counts.collect()}
    assert abs(sum(counts.get(w, 0) + 1 for w in rare) - 10.0 ** model.in_class[-1]) < 1e-6
    assert lm_score.score(tests, model).count() == len(words) + 1


def test_lm_without_training(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = lm_score.score(docs, lm_score.fit(docs, F.lit(False))).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert lm_score.score(docs.limit(0), lm_score.fit(docs, F.lit(True))).count() == 0


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_lm_invented_words_score_below_known_ones(spark, size):
    """Also where all training words would fit the vocabulary: words that no text shows must not be cheap."""
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text")
    known = docs.where("length(text) > 900").orderBy("doc_id").first()["text"].split()[:50]
    asked = spark.createDataFrame([(-1, " ".join(f"zq{i}xw{7 * i}k" for i in range(50))), (-2, " ".join(known))], docs.schema)
    rows = {r["doc_id"]: r for r in lm_score.fit_and_score(docs.unionByName(asked), F.col("doc_id") >= 0).where("doc_id < 0").collect()}
    assert rows[-1]["n_known"] == 1 and rows[-2]["n_known"] == 51
    assert rows[-1]["score"] < rows[-2]["score"] - 30 and rows[-1]["score"] < -4 * 51


def test_lm_score_by_plain_model(spark):
    """The score of a text from its definition: class shares from the weights of its features, times shares in the class."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm_score.fit(docs, F.col("doc_id") < 50)
    found = {r["doc_id"]: r["score"] for r in lm_score.score(docs, model).collect()}
    rare = {bytes(r["word"]): r["n"] for r in model.counts.collect()}
    no_id = len(model.words.ids)
    for number, text in enumerate(texts):
        own = lm_score.tokens(text)
        ids = [-1, -1, -1, *(model.words.ids.get(w, no_id) for w in own)]
        total = 0.0
        for i, word in enumerate(own, 3):
            z = model.weights[lm_score.BUCKETS].astype(float).copy()
            for row in lm_score._features(np.array(ids[i - 3 : i + 1])):
                z += model.weights[row[0]]
            p = np.exp(z - z.max())
            kind = model.classes[ids[i]]
            total += math.log10(p[kind] / p.sum())
            if ids[i] < no_id:
                mine = [j for j in range(no_id) if model.classes[j] == kind]
                total += math.log10((model.words.count[ids[i]] + 1) / sum(model.words.count[j] + 1 for j in mine))
            else:
                total += math.log10((rare.get(word, 0) + 1) / (sum(rare.values()) + len(rare) + 1))
        assert abs(found[number] - total) < 1e-3 * max(1, len(own))
