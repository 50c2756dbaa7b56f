"""Tree scoring and trie counts against plain versions of the same rules."""

import math
import re
from html import unescape

import public_tokenizers
import pytest
from gamegrain.llm import html, queries, tokencount

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_main_text():
    body = "The first paragraph, of some length, is here. " * 3
    page = (
        '<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no";</script></head><body>'
        '<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>no</p> -->'
        '<div class="ad">Buy, now, and, more, and more, of it all, please, today.</div>'
        f'<article><h1>Title &amp; more</h1><p><b>{body}<br>after &eacute;\n\n break<p>second</p><form>f</form></article>'
        '<aside>side, bar, of, words, that, are, many, and, long enough</aside>'
        '<section id="comments"><article><p>reader, says, a, lot, of, things, with, commas, here</p></article></section>'
        '<div class="cookie-notice">We use cookies.</div><footer>&copy; x</footer></body></html>'
    )
    assert html.main_text(page) == f"Title & more {body.strip()} after é break second"
    for empty in (None, "", "   ", "<p></p>", "<script>x", "<!-- x"):
        assert html.main_text(empty) == ""
    assert html.main_text("plain text") == "plain text"
    assert html.main_text("<p>a < b & c &amp</p>") == "a < b & c &"
    links = "<div>" + "".join(f'<p><a href="#">link number {i}, that is long, and has commas</a></p>' for i in range(9)) + "</div>"
    assert html.main_text(f"<body>{links}<div><p>{body}</p></div></body>") == body.strip()


def test_siblings_belong():
    text = "A paragraph of some length, with commas, that gives points, and more points. " * 3
    page = f"<body><main><h2>Head</h2><section><p>{text}</p></section><section><p>{text}</p></section></main></body>"
    assert html.main_text(page) == f"Head {text.strip()} {text.strip()}"


TEXT = "A paragraph of some length, with commas, that gives points, and more points."


@pytest.mark.parametrize("page", [
    f'<body><div class="content has-sidebar"><h1>T</h1><p>{TEXT}</p></div><div class="sidebar"><p>{TEXT}</p></div></body>',
    f'<body><article class="post with-comments"><h1>T</h1><p>{TEXT}</p></article></body>',
    f'<body><form id="aspnetForm" action="/"><div class="nav-menu"><p>{TEXT}</p></div><h1>T</h1><p>{TEXT}</p></form></body>',
    f'<body><div id="ad-free-article"><h1>T</h1><p>{TEXT}</p></div><div class="ad-slot"><p>{TEXT}</p></div></body>',
    f'<body><article><header><h1>T</h1><p>by {TEXT}</p></header><p>{TEXT}</p><footer><p>{TEXT}</p></footer></article></body>',
    f'<body><header><h1>Site</h1></header><article><h1>T</h1><p>{TEXT}</p></article><section id="comments"><article><p>{TEXT * 9}</p></article></section></body>',
    f'<body><div class="cookie-notice"><p>{TEXT}</p></div><main><h1>T</h1><p>{TEXT}</p></main><div class="site-footer">{TEXT}</div></body>',
])
def test_wrappers_do_not_hide_the_text(page):
    assert html.main_text(page) == f"T {TEXT}"


def test_short_parts_beside_the_best_one_stay():
    links = "".join(f'<a href="#">link {i}</a> ' for i in range(9))
    page = f"<body><div><section><p>{TEXT}</p></section><section><p>Short para.</p></section><div>{links}</div></div></body>"
    assert html.main_text(page) == f"{TEXT} Short para."


def test_article_of_every_page(spark, sf_dir):
    """The given pages have one article each: its text, found by a plain pattern, is the main text."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()
    found = {r.page_id: r.text for r in queries.op3_tree_scoring(spark, sf_dir).collect()}
    assert len(found) == len(pages)
    for row in pages:
        inner = re.search(r"<article[^>]*>(.*)</article>", row.html or "", re.S)
        body = re.sub(r"<(script|style).*?</\1>|<!--.*?-->", " ", inner[1] if inner else "", flags=re.S)
        words = unescape(re.sub(r"<(?!/?(?:a|b|i|em|strong|span|code)\b)[^>]*>", " ", body))
        assert found[row.page_id].split() == re.sub(r"<[^>]*>", "", words).split() or inner is None


def test_pages(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>a</p>", "x"), (2, "u", "<p>" + "word, " * 40_000 + "</p>", "x")] * 2
    schema = "page_id long, url string, html string, text string"
    out = html.extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.n_chars for r in out) == [0, 0, 1, 1, 239_999, 239_999]
    assert html.extract_pages(spark.createDataFrame([], schema)).count() == 0


def plain(scores, word):
    text = tokencount.BOUNDARY + word
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        size = len(text[end - 1].encode())
        options = [(best[end - 1][0] + size * tokencount.BYTE_LOGP, -best[end - 1][1] - size)]
        for start in range(end):
            if text[start:end] in scores:
                options.append((best[start][0] + scores[text[start:end]], -best[start][1] - 1))
        score, n = max(options)
        best.append((score, -n))
    return best[-1]


def test_counts(spark):
    scores = tokencount.piece_scores(PIECES)
    assert abs(math.fsum(math.exp(s) for s in scores.values()) - 1) < 1e-9
    words = "the there then 中文 thethethe naïve don't x123 \U0001f600 Straße the".split()
    rows = [(1, " ".join(words), 1), (2, None, 1), (3, "", 1), (None, "the  the\n", 1), (4, "z" * 3000, 1)]
    schema = "doc_id long, text string, n_tokens int"
    out = {r.doc_id: r for r in tokencount.count_tokens(spark.createDataFrame(rows, schema), PIECES).collect()}
    want = [plain(scores, w) for w in words]
    assert out[1].n_words == len(words) and out[1].n_tokens == sum(n for _, n in want)
    assert abs(out[1].score - sum(s for s, _ in want)) < 1e-6
    assert out[2].n_tokens == out[3].n_tokens == 0
    assert out[None].n_words == 2 and out[4].n_tokens == plain(scores, "z" * 3000)[1]
    assert tokencount.count_tokens(spark.createDataFrame([], schema), PIECES).count() == 0


def test_a_full_trie_is_grown_anew(monkeypatch):
    scores = tokencount.piece_scores(PIECES)
    monkeypatch.setattr(tokencount, "NODES", 200)
    trie = tokencount.UnigramTrie(scores)
    for i in range(50):
        words = {f"word{i}", f"other{i * 7}"}
        trie.learn(words)
        assert all(trie.count[w] == plain(scores, w)[1] for w in words)
    assert len(trie.forward) < 200
