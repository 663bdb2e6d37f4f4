import html
import random
import re

import pytest

from pulsevault.llm.page_tree import Node, parse, texts
from pulsevault.llm.wrapper import _matching, extracted, main_text, packed_tree, unpacked_tree

SCHEMA = "page_id long, url string, html string, text string, host string"


def extract(page):
    return main_text(parse(page), set(), {})


@pytest.mark.parametrize("page, want", [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b", "a\n\nb"),
    ("<article><h1>T</h1><p>one\n two&nbsp;<b>x</b>y<br>z</p><ul><li>p<li>q</ul></article><footer>f", "T\n\none two xy z\n\np\n\nq"),
    ("<nav>n</nav><div class=ad>a</div><main><p>m</p><aside>s</aside><form>f</form></main>", "m"),
    ("<article>a<section class='reader-comments'><article>c</article></section></article>", "a"),
    ("<article><header><h1>T</h1></header>x<div class='article-footer'>f</div></article>", "T\n\nx"),
    ("<script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes", "yes"),
    ("<div id=header>h</div><div class='cookie-notice'>c</div><div><p>t</p></div>", "t"),
    ("<p>a &lt;b&gt; &#233; &eacute; &unknown; 1 < 2</p>", "a <b> é é &unknown; 1 < 2"),
    ("<p title='a>b'>x</p><img src=x><p hidden>no</p>", "x"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ("<article><p>cut of", "cut of"),
    ("<p>a</div></p>b<script>never closed", "a\n\nb"),
])
def test_pages(page, want):
    assert extract(page) == want


def tree(rng, depth=3):
    node = Node(rng.choice("ab"))
    if depth:
        node.children = [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return node


def plain_match(a, b):
    """Size of the largest matching, by trying every pairing of the children in order."""
    if a.label != b.label:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        w = plain_match(x[0], y[0])
        return max(best(x[1:], y), best(x, y[1:]), w + best(x[1:], y[1:]) if w else 0)
    return 1 + best(a.children, b.children)


@pytest.mark.parametrize("wide", [0, 64])
def test_tree_matching_is_the_largest(wide, monkeypatch):
    monkeypatch.setattr("pulsevault.llm.wrapper._WIDE", wide)
    rng = random.Random(4)
    for _ in range(200):
        a, b = tree(rng), tree(rng)
        size, pairs = _matching(a, b)
        assert size == plain_match(a, b) == len(pairs)
        assert all(x.label == y.label for x, y in pairs)


@pytest.mark.parametrize("wide", [0, 64])
def test_equal_texts_choose_among_the_largest_matchings(wide, monkeypatch):
    """Against all matchings of two lists of paragraphs, some texts in both: size first, then equal texts."""
    monkeypatch.setattr("pulsevault.llm.wrapper._WIDE", wide)
    from functools import cache
    rng = random.Random(6)
    for _ in range(150):
        left, right = ([rng.randint(1, 5) for _ in range(rng.randint(0, 7))] for _ in range(2))
        page = lambda ks: parse("<div>" + "".join(f"<p>{k}</p>" if k % 2 else f"<ul><li>{k}<li>x{k}</ul>" for k in ks) + "</div>")
        a, b = page(left), page(right)
        values = lambda root: {id(t): hash(t.text) | 1 for t in texts(root)}
        size, pairs = _matching(a, b, values(a), values(b))

        @cache
        def best(i, j):
            if i == len(left) or j == len(right):
                return 0, 0
            options = [best(i + 1, j), best(i, j + 1)]
            if left[i] % 2 == right[j] % 2:
                n, e = best(i + 1, j + 1)
                options.append((n + (2 if left[i] % 2 else 5), e + (left[i] == right[j]) * (1 if left[i] % 2 else 2)))
            return max(options)
        equal = sum(x.text is not None and x.text == y.text for x, y in pairs)
        base = 2 if left and right else len(pairs) - best(0, 0)[0]
        assert (size, equal) == (base + best(0, 0)[0], best(0, 0)[1]) and len(pairs) == size


def test_long_lists_of_siblings_take_little_memory():
    import tracemalloc
    page = lambda n, k: parse("<ul>" + "".join(f"<li><p>{k} {i}</p><p>{(i * i + n) % 7}</p></li>" for i in range(n)) + "</ul>")
    a, b = page(6000, "x"), page(5000, "y")
    values = lambda root: {id(t): hash(t.text) | 1 for t in texts(root)}
    ours, theirs = values(a), values(b)
    tracemalloc.start()
    size, _ = _matching(a, b, ours, theirs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size == 2 + 5 * 5000 and peak < 100 << 20


def test_trees_survive_packing():
    page = parse("<div class=x><p>a<p>b<ul><li>c</ul></div>d")
    again = unpacked_tree(packed_tree(page))
    assert packed_tree(again) == packed_tree(page) and len(texts(again)) == len(texts(page)) == 4


def test_template_of_a_host_without_telling_marks(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(6))
    para = lambda: " ".join(word() for _ in range(12))
    rows, want = [], {}
    for i in range(60):
        host = ("one.example", "two.example", "single.example")[0 if i < 40 else 1 if i < 59 else 2]
        body = [para() for _ in range(rng.randint(1, 5))]
        top = f"<div>Welcome to {host}</div><div><span>Sections</span> A B C</div>"
        end = f"<div>All rights of {host}</div>"
        rows.append((i, f"http://{host}/{i}", f"<html><body>{top}<div>{''.join(f'<p>{p}</p>' for p in body)}</div>{end}", "x", "y"))
        want[i] = "\n\n".join(body)
    copy = rows[0]
    rows += [(100 + i, copy[1], copy[2], "x", "y") for i in range(80)] + [(200, None, None, "x", "y"), (None, "no scheme", "<p>t", "x", "y")]
    got = {r.page_id: r for r in extracted(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert len(got) == len(rows)
    for i in range(59):
        assert got[i].text == want[i]
    assert all(got[100 + i].text == want[0] for i in range(80))
    assert got[59].text.startswith("Welcome") and got[200].text == "" and got[None].text == "t"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extracted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rare_texts_of_a_template_slot_stay(spark):
    page = lambda top, i: f"<div class=x>{top}</div><p>body {i}</p><article><h2>Our news</h2><p>news {i}"
    tops = ["Open today"] * 170 + [f"Closed for reason {i}" for i in range(30)]
    rows = [(i, f"http://notes.example/{i}", page(t, i).replace("article", "section"), "x", "y") for i, t in enumerate(tops)]
    rows += [(1000 + i, f"http://small.example/{i}", page("Top", i), "x", "y") for i in range(12)]
    got = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for i, t in enumerate(tops):
        assert got[i] == "\n\n".join(([t] if i >= 170 else []) + [f"body {i}", f"news {i}"])
    assert all(got[1000 + i].endswith(f"news {i}") and "Our news" not in got[1000 + i] for i in range(12))


@pytest.mark.parametrize("chars", [0, 64 << 20])
def test_second_layout_and_blocks_that_the_reference_lacks(spark, chars, monkeypatch):
    monkeypatch.setattr("pulsevault.llm.wrapper.BROADCAST_CHARS", chars)
    rng = random.Random(2)
    rows, want = [], {}
    for i in range(100):
        body = [f"text {i} {k}" for k in range(rng.randint(1, 6))]
        ps = "".join(f"<p>{b}</p>" for b in body)
        if i % 20 < 11:  # a constant paragraph after a run of paragraphs, on most pages a second one
            page = f"<div class=a>Top</div><div class=c>{ps}<p>Read our other news</p>{'<p>Call us</p>' if i % 5 else ''}</div>"
        else:
            page = f"<section class=z><h2>Other layout</h2></section><ul><li>Welcome</ul><section class=t>{ps}</section>"
        rows.append((i, f"http://two.example/{i}", page, "x", "y"))
        want[i] = "\n\n".join(body)
    got = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == want


def test_names_neither_empty_a_page_nor_hide_text_of_a_large_host(spark):
    shared = lambda i: f"<div>Top</div><div class='share-body'><p>Menu of all</p><p>story {i}</p></div>"
    cards = lambda i: f"<div class=head>Top</div><div class=t><p>story {i}</p></div><article><h2>Our shop</h2></article>"
    rows = [(i, f"http://a.example/{i}", shared(i), "x", "y") for i in range(20)]
    rows += [(100 + i, f"http://b.example/{i}", cards(i), "x", "y") for i in range(20)]
    rows += [(200, "http://c.example/1", "<aside><p>story 200</p></aside>", "x", "y"), (201, "http://d.example/1", cards(201), "x", "y")]
    got = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    want = {i: f"story {i}" for i in range(20)} | {100 + i: f"story {i}" for i in range(20)} | {200: "story 200", 201: "Our shop"}
    assert got == want


def test_a_very_deep_page(spark):
    deep = "<div>" * 5000 + "end"
    root = parse(deep)
    assert packed_tree(unpacked_tree(packed_tree(root))) == packed_tree(root)
    assert _matching(root, parse(deep))[0] == 5002
    rows = [(i, f"http://deep.example/{i}", f"{deep}{i}", "x", "y") for i in range(10)]
    got = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()}
    assert got == {i: f"end{i}" for i in range(10)}


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    from pulsevault.llm import wrapper
    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        want[r.page_id] = "\n\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in wrapper.extracted(pages).collect()} == want


@pytest.mark.parametrize("page,want", [
    ("<noscript><p>Enable JS</p></noscript><p>Text one.</p>", "Text one."),
    ("<p>Text one.</p><button><div>Share this</div></button><p>Text two.</p>", "Text one.\n\nText two."),
    ("<template><div>Draft</div></template><p>Text <b>one</b>.</p>", "Text one."),
    ("<div><object><p>No plugin</p><p>at all</p></object>Text one.</div>", "Text one."),
    ("<p>before <button>x</button> after</p>", "before after"),
    ("<p data=it's>one</p><p>two</p><p>it's three</p>", "one\n\ntwo\n\nit's three"),
    ("<p title = \"a > b\" class='x'>one</p><p title=a\"b'c>two</p>", "one\n\ntwo"),
    ("<div class='user-feedback'><p>Me too!</p></div><p>Text one.</p>", "Text one."),
    ("<p><a href=x>All of it is a link</a></p>", "All of it is a link"),
])
def test_odd_markup(page, want):
    assert main_text(parse(page), set(), {}) == want


def test_many_open_elements_and_attributes_parse_in_linear_time():
    import time
    start = time.time()
    assert main_text(parse("<div>" * 100_000 + "deep"), set(), {}) == "deep"
    assert main_text(parse("<p " + "a= " * 200_000 + ">one" + "<p x='" * 3), set(), {}) == "one"
    assert time.time() - start < 20
