import zlib

import numpy as np
import pytest
from cohortlens.llm import html_text
from cohortlens.session import Workspace

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now</div>{body}
<aside>See also</aside><form><input><button>Send</button></form><div id="comments"><p>First!</p></div>
<div class="cookie-notice">We use cookies</div><footer>&copy; me</footer></body></html>"""


def text(html):
    return " ".join(t for _, t in html_text.page_blocks(html))


@pytest.mark.parametrize(
    "body,expected",
    [
        ("<article><h1>A  b</h1><p>One&amp;two<br>three</p></article>", "A b One&two three"),
        ("<article><h1>X</h1><p><b>Y.<br><p>Z</p></article>", "X Y. Z"),
        ("<main><p>a<nav>menu</nav>b</p></main>", "a b"),
        ("<article><header><h1>H</h1></header>t<ul><li>i<li>j</ul></article>", "H t i j"),
        ("<article><p>wo<b>r</b>d &lt;tag&gt; &#65; &eacute;&nbsp;x</p></article>", "word <tag> A é x"),
        ("<article><p>a</p><div class='comments'>c</div><!-- d --><script>e</script></article>", "a"),
        ("<div>just <i>text</i></div><p>more</p>", "just text more"),
        ("<article><p>never closed", "never closed"),
        ("<article>1</article><article>2</article>", "1 2"),
        ("<p>shadow</p><div role='main'>main</div>", "main"),
        ("<article class='post'><p>download adobe</p><p class='loading-bar'>x</p></article>", "download adobe x"),
    ],
)
def test_main_text(body, expected):
    assert text(PAGE.format(body=body)) == expected


@pytest.mark.parametrize(
    "body,expected",
    [
        ("<div class='content with-sidebar'><article>a</article></div>", "a"),
        ("<article class='post no-comments'>a</article>", "a"),
        ("<div id='search-results-page'><article>a</article></div>", "a"),
        ("<div id='sidebar'><article>a<p class='ad'>b</p></article></div>", "a"),
        ("<article>a</article><div class='related'><article>teaser</article></div>", "a"),
        ("<div class='main-sidebar'>b</div><article>a</article>", "a"),
        ("<form id='aspnetForm'><nav>b</nav><article>a</article></form>", "a"),
        ("<form><nav>b</nav><p>long text of the page</p><button>c</button></form><p>x</p>", "long text of the page x"),
        ("<form><p>Search</p></form><p>long text of the page</p>", "long text of the page"),
        ("<article>a <svg viewBox='0 0 1 1'/> b <math/> c</article>", "a b c"),
        ("<article>a <svg><text>x</text></svg> b</article>", "a b"),
        ("<div class='comments'>all there is<p hidden>x</p></div>", "all there is"),
    ],
)
def test_no_page_loses_its_text(body, expected):
    assert text(f"<html><head><title>T</title></head><body>{body}</body></html>") == expected


@pytest.mark.parametrize("html", [None, "", "<", "<p", "&amp", "<!-- ", "<script>", "</p></div>", "\0", "<p>" * 3000])
def test_broken_pages(html):
    assert isinstance(text(html), str)


def brute_cover(pages, depth):
    """Tokens covered by windows, or whole shorter blocks, that another page has too."""
    seen = {}
    for p, blocks in enumerate(pages):
        for b in blocks:
            words = b.split(" ")
            for i in range(max(1, len(words) - depth + 1)):
                seen.setdefault((len(words) < depth, tuple(words[i : i + depth])), set()).add(p)
    cover = []
    for blocks in pages:
        for b in blocks:
            words = b.split(" ")
            gone = [False] * len(words)
            for i in range(max(1, len(words) - depth + 1)):
                if len(seen[len(words) < depth, tuple(words[i : i + depth])]) > 1:
                    gone[i : i + depth] = [True] * len(words[i : i + depth])
            cover += gone
    return cover


@pytest.mark.parametrize("seed,depth", [(0, 3), (1, 5), (2, 8)])
def test_suffix_array_finds_what_pages_share(seed, depth):
    rng = np.random.default_rng(seed)
    shared = [" ".join(rng.choice(list("abcdef"), 12)) for _ in range(3)]
    pages = [
        [" ".join([*rng.choice(list("abcdefghij"), rng.integers(1, 15)), rng.choice(shared)]) for _ in range(3)] + ["a b"] for _ in range(12)
    ]
    assert html_text.Streams(pages).repeated(depth).tolist() == brute_cover(pages, depth)


def test_suffix_ranks_agree_with_sorting():
    tokens = np.random.default_rng(3).integers(0, 3, 60)
    for depth in (1, 2, 3, 5, 8):
        order, _ = html_text.suffix_array(tokens, depth)
        starts = [tuple(tokens[i : i + depth]) for i in order]
        assert starts == sorted(starts)


MENU = "home about contact products services team imprint and more"


def candidate(i, host="a.example"):
    own = " ".join(f"w{i}x{k}" for k in range(20))
    return (i, f"https://{host}/p{i}", f"<body><div>{MENU}</div><div>{own}</div><div>all rights reserved</div></body>", "clash")


@pytest.mark.parametrize("pages_per_shard", [2000, 3])
def test_boilerplate_of_a_host_goes(spark, pages_per_shard):
    rows = [candidate(i) for i in range(20)] + [candidate(50, "b.example"), (60, None, None, None), (61, "x", "", None)]
    rows += [(62, "https://a.example/z", f"<article>{MENU}</article>", None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    found = {r.page_id: r for r in html_text.extract(table, pages_per_shard=pages_per_shard).collect()}
    assert all(found[i].text == " ".join(f"w{i}x{k}" for k in range(20)) for i in range(20))
    assert found[50].text.startswith(MENU) and found[50].n_chars == len(found[50].text)
    assert (found[60].text, found[60].n_chars, found[60].url) == ("", 0, None) and found[61].text == ""
    # What an article holds stays, also where the host repeats it.
    assert found[62].text == MENU


@pytest.mark.parametrize("pages_per_shard", [2000, 3])
def test_real_text_of_a_host_stays(spark, pages_per_shard):
    def page(i, url, *blocks):
        return (i, url, "".join(f"<div>{b}</div>" for b in blocks))

    own = [" ".join(f"w{i}x{k}" for k in range(12)) for i in range(40)]
    # Twenty copies at different urls, ten pages of which two share a heading and a quotation, and pages without host.
    quoted = [own[20], own[21]]
    rows = [page(i, f"https://a.example/c{i}", MENU, own[0]) for i in range(20)]
    rows += [page(i, f"https://a.example/p{i}", MENU, own[i], *(["Introduction", own[39]] if i < 22 else [])) for i in range(20, 30)]
    rows += [page(30, None, MENU, own[30]), page(31, "/x", MENU, own[31]), page(32, None, MENU, own[32]), page(33, None, MENU, own[32])]
    rows += [page(i, "https://b.example/", MENU) for i in (34, 35, 36, 36)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    result = html_text.extract(table, pages_per_shard=pages_per_shard).collect()
    found = {r.page_id: r.text for r in result}
    assert len(result) == len(rows)
    assert {found[i] for i in range(20)} == {own[0]}
    assert [found[20], found[21]] == [f"{q} Introduction {own[39]}" for q in quoted]
    assert all(found[i] == own[i] for i in range(22, 30))
    assert [found[i] for i in (30, 31, 32, 33)] == [f"{MENU} {own[min(i, 32)]}" for i in (30, 31, 32, 33)]
    assert {found[i] for i in (34, 35, 36)} == {MENU}


@pytest.mark.parametrize("pages_per_shard", [2000, 3])
def test_pages_with_articles_pass_the_suffix_arrays(spark, pages_per_shard):
    """Repeats among all visible blocks of a host are found; the check by elements keeps the article and drops the rest."""
    quoted = " ".join(f"q{k}" for k in range(10))

    def page(i, host, *article):
        inside = "".join(f"<p>{b}</p>" for b in article)
        return (i, f"https://{host}/p{i}", PAGE.format(body=f"<div>{MENU}</div><div>only{i}</div><article>{inside}</article>"))

    own = [" ".join(f"w{i}x{k}" for k in range(12)) for i in range(30)]
    rows = [page(i, "a.example", own[i], quoted) for i in range(20)] + [page(i, "b.example", own[i]) for i in (20, 21)]
    # A copy at another address, and the host's page without an article, which is searched among its like.
    rows += [(22, "https://a.example/copy", rows[0][2]), (23, "https://a.example/x", f"<div>{MENU}</div>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: r for r in html_text.extract(table, pages_per_shard=pages_per_shard).collect()}
    assert len(found) == len(rows)
    assert all(found[i].text == f"{own[i]} {quoted}" for i in range(20)) and found[22].text == found[0].text
    # The menu, the quotation and the short blocks of PAGE are repeats.
    furniture = "Site name Home Buy now See also Send First! We use cookies © me".split()
    assert {found[i].n_repeated for i in (*range(20), 22)} == {len(MENU.split()) + 10 + len(furniture)}
    assert all(found[i].text == own[i] and found[i].n_repeated == 0 for i in (20, 21))
    assert found[23].text == MENU and found[23].n_repeated == 0


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_shards_decide_like_one_suffix_array(spark, seed, monkeypatch):
    """Many pages over many shards, cut by number and by size, lose what a brute-force count removes."""
    rng = np.random.default_rng(seed)
    shared = [" ".join(rng.choice(list("abcdef"), rng.integers(3, 14))) for _ in range(6)]
    pages = []
    for i in range(60):
        own = " ".join(rng.choice(list("uvwxyz"), 10))
        pages.append([s for k, s in enumerate(shared) if rng.random() < 0.15 * (k + 2)] + [f"p{i} {own}"])
    places = {}
    for p, blocks in enumerate(pages):
        for block in blocks:
            words = block.split(" ")
            for i in range(max(1, len(words) - 7)):
                places.setdefault((len(words) < 8, tuple(words[i : i + 8])), set()).add(p)
    least = {False: 18, True: 54}
    expected = []
    for blocks in pages:
        kept = []
        for block in blocks:
            words = block.split(" ")
            gone = set()
            for i in range(max(1, len(words) - 7)):
                if len(places[len(words) < 8, tuple(words[i : i + 8])]) >= least[len(words) < 8]:
                    gone.update(range(i, min(i + 8, len(words))))
            kept += [w for i, w in enumerate(words) if i not in gone]
        expected.append(" ".join(kept))
    rows = [(i, "http://h.example/x", "".join(f"<div>{b}</div>" for b in blocks)) for i, blocks in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for per_shard, chars in ((2000, 1 << 25), (7, 1 << 25), (2000, 500), (1, 1 << 25)):
        monkeypatch.setattr(html_text, "CHARS_PER_SHARD", chars)
        found = {r.page_id: r.text for r in html_text.extract(table, pages_per_shard=per_shard).collect()}
        assert [found[i] for i in range(60)] == expected, (per_shard, chars)
    assert any(len(e) < sum(map(len, b)) for e, b in zip(expected, pages, strict=True))


def test_empty_table(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()


def test_articles_of_the_given_pages(spark, sf_dir):
    """Every page of the smallest table marks its article; its blocks are found there by pattern."""
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = (re.sub(r"<[^>]+>", "", b) for b in re.split(r"</?(?:p|h1|br)[^>]*>", inside))
        cleaned = (" ".join(html.unescape(b).split()) for b in blocks)
        assert found[row.page_id] == " ".join(b for b in cleaned if b)


def prose_pages(n, host="a.example"):
    """Pages with a menu, words of their own and a closing line."""
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(2000)]
    return [(i, f"https://{host}/p{i}", f"<body><div>{MENU}</div><div>{' '.join(rng.choice(words, 300))}</div></body>") for i in range(n)]


@pytest.mark.parametrize("pages_per_shard", [2000, 100])
def test_texts_are_stored_once(spark, tmp_path, pages_per_shard):
    """What a run writes, its shuffles apart, is less than the pages' blocks are when each is compressed once."""
    rows = prose_pages(400)
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    once = sum(len(zlib.compress(" ".join(t for _, t in html_text.page_blocks(html)).encode())) for *_, html in rows)
    with Workspace(spark, str(tmp_path)) as workspace:
        found = html_text.extract(table, pages_per_shard=pages_per_shard, workspace=workspace).collect()
        written = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert all(r.n_repeated == len(MENU.split()) and r.n_chars == len(r.text) for r in found) and len(found) == len(rows)
    assert written < once


@pytest.mark.parametrize("chars_per_pack", [1 << 24, 5000])
def test_shards_of_a_host_of_copies_are_merged(spark, monkeypatch, chars_per_pack):
    """A host whose many rows have few contents is decided like one suffix array, over any packs; null keys and urls are pages, too."""
    monkeypatch.setattr(html_text, "CHARS_PER_PACK", chars_per_pack)
    shown = prose_pages(9)
    # Markup differs, blocks do not.
    rows = [(k * 10 + i, url, f"<script>{k}</script>{html}") for k in range(12) for i, url, html in shown]
    rows += [(None, shown[0][1], shown[0][2]), (None, None, shown[1][2]), (500, None, shown[1][2]), (501, shown[0][1], None)]
    rows += [(600 + i, f"https://b.example/{i}", html) for i, _, html in shown[:2] * 20]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    results = [
        sorted(map(tuple, html_text.extract(table, pages_per_shard=n).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2]))
        for n in (2000, 4, 1)
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == len(rows)
    own = {i: html.split("</div><div>")[1].removesuffix("</div></body>") for i, _, html in shown}
    for key, url, text, n_chars, n_repeated in results[0]:
        alone = url is None or "b.example" in url
        if key == 501:
            assert (text, n_chars, n_repeated) == ("", 0, 0)
        elif key is not None and key < 500:
            assert (text, n_repeated) == (own[key % 10], len(MENU.split()))
        else:
            assert text.startswith(MENU) == alone and n_repeated == (0 if alone else len(MENU.split()))
