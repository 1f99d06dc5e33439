"""HTML extraction: pages by hand, and repeats of a host against a plain search for equal windows."""

import random

import pytest

from panelrank.llm import html_extract as H

SCHEMA = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a><li>B</ul></nav><!-- ad 1 --><div class="ad">Buy now.</div>{}<aside>More</aside>
<section id="comments"><article class="comment">First!</article></section><form><p>Mail <input name=x></form><footer>&copy; site</footer></body></html>"""


def text_of(page):
    parts = H.blocks(page)
    best = max((level for _, _, level, out in parts if not out), default=0)
    return "\n\n".join(t for _, t, level, out in parts if level == best and not out)


@pytest.mark.parametrize(
    "page, text",
    [
        (PAGE.format("<article><h1>Tit\n le</h1><p><b>One &lt;x&gt;<br>two.<br><p>Three &amp; &eacute; 4 < 5.</article>"), "Tit le\n\nOne <x> two.\n\nThree & é 4 < 5."),
        (PAGE.format("<main><div class='share-bar'>Share</div><p>Body.</p><div>Side</div></main>"), "Body.\n\nSide"),
        (PAGE.format("<main><p>Teaser</p><article>Full</article></main>"), "Full"),
        (PAGE.format('<div class="post-content"><p>Text.<div class="newsletter">Sign up</div></div>'), "Text."),
        (PAGE.format("<article><p class=notice>We use cookies.<p>Text<table><tr><td>a<td>b</tr></table><ul><li>x<li>y<ul><li>z</ul></ul></article>"), "Text\n\na b\n\nx\n\ny\n\nz"),
        ("<form action=x><article>Inside</article></form>", "Inside"),
        ("<article>it's <p it's>fine</p> <i>in</i>line<!-- c -->d &am", "it's\n\nfine\n\ninlined &am"),
        ("<article>cut <b>off</b> here <a href=\"x", "cut off here"),
        ("<article>a<!-- never ends <p>b", "a"),
        ("<article>a<script>x <p>y", "a"),
        ("<article><header><h1>Head</h1></header>x</article>", "Head\n\nx"),
        ("just text", "just text"),
        ("<html><head><title>x</title><p>no body tag", "no body tag"),
        ("<nav>menu</nav>", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_pages_by_hand(page, text):
    assert text_of(page) == text


def test_long_and_odd_pages_are_read_in_linear_time():
    for page in ("<b>" * 200_000 + "</i>" * 200_000, '<a x="' * 100_000, "<" * 300_000, "<p a='" * 100_000 + "x", "<!--" * 100_000, "<script>" * 50_000, "<li><ul>" * 60_000, "&" * 300_000):
        H.blocks(page)
    assert text_of("<article><p>" + "word " * 400_000).count(" ") == 399_999


def made(seed, hosts=3, pages=14):
    """Pages without an article: some blocks are shared by pages of a host, some by all, others are their own."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 4)
    common = [" ".join(word() for _ in range(rng.randint(2, 14))) for _ in range(5)]
    rows = []
    for h in range(hosts):
        mine = [" ".join(word() for _ in range(rng.randint(3, 12))) for _ in range(3)]
        for p in range(pages):
            parts = [f"<{rng.choice(['p', 'div', 'h2'])}>{rng.choice(mine + common) if rng.random() < 0.6 else ' '.join(word() for _ in range(rng.randint(1, 30)))}" for _ in range(rng.randint(0, 8))]
            rows.append((len(rows), f"https://h{h}.example.org/{p}", "".join(parts)))
    rows += [(len(rows), rows[3][1], rows[3][2]), (len(rows) + 1, None, rows[5][2]), (len(rows) + 2, "no url", None), (None, rows[0][1], "<article>x</article>")]
    return rows


def plain(rows, n):
    """Covers tokens that lie in windows of n tokens found on another page (with other tokens) of the host."""
    hosts = {}
    for i, (_, url, html) in enumerate(rows):
        host = (url or "").split("/")[2] if (url or "").startswith("http") else ""
        parts = H.blocks(html)
        tokens = [] if any(level for _, _, level, _ in parts) else [(t, b) for b, (e, text, _, _) in enumerate(parts) for t in [f"<{e}>", *text.split(" ")]]
        hosts.setdefault(host, []).append((i, tokens))
    out = {}
    for pages in hosts.values():
        for i, tokens in pages:
            words = [t for t, _ in tokens]
            theirs = {tuple(w[j : j + n]) for k, o in pages for w in [[t for t, _ in o]] if k != i and w != words for j in range(len(w) - n + 1)}
            gone = {j + x for j in range(len(words) - n + 1) if tuple(words[j : j + n]) in theirs for x in range(n)}
            kept = {}
            for j, (t, b) in enumerate(tokens):
                if j not in gone and not (t.startswith("<") and t.endswith(">")):
                    kept.setdefault(b, []).append(t)
            out[i] = "\n\n".join(" ".join(kept[b]) for b in sorted(kept))
    return out


@pytest.mark.parametrize("shard_tokens", [1 << 21, 60])
def test_repeats_by_plain_search(spark, shard_tokens):
    """Also with hosts dealt over many shards."""
    rows = made(4)
    df = spark.createDataFrame([(i, u, h, "x", 7) for i, (_, u, h) in enumerate(rows)], SCHEMA + ", text string, host int").repartition(3)
    made_rows = H.extract(df, 5, shard_tokens).collect()
    found = {r["page_id"]: r["text"] for r in made_rows}
    wanted = plain(rows, 5)
    assert all(r["n_repeated"] <= r["n_outside"] for r in made_rows) and sum(r["n_repeated"] for r in made_rows) > 100
    wanted[len(rows) - 1] = "x"
    assert found == wanted
    assert sum(found[i] != text_of(rows[i][2]) for i in range(len(rows))) > 20


def test_suffix_ranks_order_suffixes():
    import numpy as np

    rng = random.Random(1)
    tokens = np.array([rng.randint(0, 3) for _ in range(200)])
    for depth in (1, 3, 8):
        rank = H.suffix_ranks(tokens, depth)
        keys = [tuple(tokens[i : i + depth]) for i in range(200)]
        assert [rank[i] for i in range(200)] == [sorted(set(keys)).index(k) for k in keys]


def test_copies_within_articles_stay(spark):
    body = "<article><p>" + "the same long words in every article here " * 3 + "</article>"
    df = spark.createDataFrame([(i, "https://a.example/", f"<div>Follow us on all the networks and more {i % 2}</div>{body}") for i in range(4)], SCHEMA)
    assert {r["text"] for r in H.extract(df).collect()} == {("the same long words in every article here " * 3).strip()}
    assert H.extract(df.where("false")).count() == 0


def whole(rows, n):
    """(text, n_outside, n_repeated, n_article, n_copied) of each row, by comparing all windows of all pages of a host, articles too."""
    hosts = {}
    for i, (_, url, html) in enumerate(rows):
        parts = H.blocks(html)
        best = max((level for _, _, level, out in parts if not out), default=0)
        tokens = [(t, best and level == best and not out, b, out) for b, (e, text, level, out) in enumerate(parts) for t in [f"<{e}>", *text.split(" ")]]
        hosts.setdefault((url or "").split("/")[2] if (url or "").startswith("http") else "", {})[i] = tokens
    found = {}
    for pages in hosts.values():
        at = {}
        for tokens in pages.values():
            for j in range(len(tokens) - n + 1):
                w = tokens[j : j + n]
                at.setdefault(tuple(t for t, *_ in w), set()).add((tuple(tokens), all(main for _, main, _, _ in w)))
        for i, tokens in pages.items():
            cover, gone, told = set(), set(), set()
            for j in range(len(tokens) - n + 1):
                on = at[tuple(t for t, *_ in tokens[j : j + n])]
                if len({page for page, _ in on}) > 1:
                    cover |= set(range(j, j + n))
                if len({page for page, inside in on if not inside}) > 1:
                    gone |= set(range(j, j + n))
                if any(inside for _, inside in on):
                    told |= set(range(j, j + n))
            article, kept = any(main for _, main, _, _ in tokens), {}
            for j, (t, main, b, out) in enumerate(tokens):
                first = not j or tokens[j - 1][2] != b
                if not first and (main if article else not out and j not in gone - told):
                    kept.setdefault(b, []).append(t)
            mains = {j for j, (_, main, _, _) in enumerate(tokens) if main}
            found[i] = ("\n\n".join(" ".join(kept[b]) for b in sorted(kept)), len(tokens) - len(mains), len(cover - mains), len(mains), len(cover & mains))
    return found


@pytest.mark.parametrize("shard_tokens", [1 << 21, 60])
def test_whole_pages_by_plain_search(spark, shard_tokens):
    """Words of articles join the arrays: they are counted, tell pages apart and keep their text on pages without an article."""
    rng = random.Random(7)
    rows = [(i, url, html) for i, (_, url, html) in enumerate(made(6))]
    for i, url, html in rows[::2]:
        other = rng.choice(rows)[2] or ""
        rows[i] = (i, url, f"<div>{rng.choice(['Follow us on all the networks', 'x'])}</div><article>{html}<nav>in the article a menu of words</nav></article><p>{other}")
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["page_id"]: (r["text"], r["n_outside"], r["n_repeated"], r["n_article"], r["n_copied"]) for r in H.extract(df, 5, shard_tokens).collect()}
    assert found == whole(rows, 5)
    assert sum(f[4] for f in found.values()) > 100


def test_the_same_boilerplate_around_articles_is_found(spark):
    """Pages that differ in their articles only are not copies of one page; a print version of an article keeps its text."""
    around = "<div>" + " ".join(f"b{i}" for i in range(20)) + "</div>"
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(30))
    rows = [(i, "https://a.example/", f"{around}<article>{own(i)}</article>") for i in range(4)]
    rows += [(4, "https://a.example/", around), (5, "https://a.example/", f"{around}<p>{own(1)}"), (6, "https://a.example/", f"{around}<p>{own(1)}<p>printed")]
    found = {r["page_id"]: r for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [found[i]["n_repeated"] for i in range(4)] == [21] * 4 and [found[i]["text"] for i in range(4)] == [own(i) for i in range(4)]
    assert [found[i]["text"] for i in (4, 5, 6)] == ["", own(1), own(1) + "\n\nprinted"]


def test_pages_without_blocks(spark):
    found = H.extract(spark.createDataFrame([(1, None, None)], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(1, None, "", 0, 0, 0, 0)]
