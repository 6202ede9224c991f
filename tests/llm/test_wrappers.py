import html
import random
import re

import pytest

from civitally.llm import wrappers as w
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def by_article(page):
    """The text of the only article of a generated page, by its block tags."""
    body = re.search("<article>(.*)</article>", page, re.DOTALL)[1]
    blocks = re.split("</?(?:p|h1)>", body)
    plain = (" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in blocks)
    return "\n".join(b for b in plain if b)


def test_query_reads_every_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op8_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == by_article(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def read(spark, ws, rows, clash=False):
    df = spark.createDataFrame(rows, PAGES)
    if clash:
        df = df.selectExpr("*", "'x' as host", "'y' as main", "'z' as text", "1 as key")
    return sorted(((r.page_id, r.text) for r in w.extract(df, ws).collect()), key=repr)


RICH = """<!DOCTYPE html><html><head><title>T</title><style>x{}</style></head><body class="page">
<header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><nav><a href=/>Home</a></nav>
<main><article class="post"><h2>A &amp; B&nbsp;&eacute;</h2><p>One
  two<b>three</b>.<p>Four<br>five <a href="/x">six</a><div class="ad">Buy</div><form><input><p>sign up</p></form>
<ul><li>l1<li>l2</ul><script>if (a<b) "</p>"</script><section class="comments"><p>Nice!</p></section></article></main>
<aside class="sidebar">Side</aside><footer>&copy; us</footer></body></html>"""
RICH_TEXT = "A & B é\nOne twothree.\nFour five six\nl1\nl2"


def test_surroundings_go_and_the_article_stays(spark, ws):
    assert read(spark, ws, [(1, "http://a.b/1", RICH)]) == [(1, RICH_TEXT)]


def test_templates_of_a_host_are_read_apart(spark, ws):
    """Articles, main elements, named parts, plain markup and teaser cards; hosts and no hosts."""
    long = "many words of text " * 9
    pages = [
        (f"<body><article><p>{long}a</p></article></body>", f"{long}a"),
        (f"<body><main><p>{long}b</p></main></body>", f"{long}b"),
        (f"<body><div class=content><p>{long}c</p></div></body>", f"{long}c"),
        (f"<body><div><p>{long}d</p></div></body>", f"{long}d"),
        (f"<body><main><p>{long}e</p></main><section><article>card</article><article>card</article></section></body>", f"{long}e"),
        (f"<body><div><p>{long}f</p></div><article>card</article></body>", f"{long}f\ncard"),
        (f"<body><main><p>{long}g</p><article>card</article></main></body>", f"{long}g\ncard"),
    ]
    urls = ["http://one.host/", None, "", "no host"]
    rows = [(10 * i + k, url, page) for i, (page, _) in enumerate(pages) for k, url in enumerate(urls)]
    assert read(spark, ws, rows) == sorted(
        ((10 * i + k, want) for i, (_, want) in enumerate(pages) for k in range(len(urls))), key=repr
    )


def test_wrapper_tells_template_from_slots(spark, ws, monkeypatch):
    """Texts on every page go wherever they stand; texts of some pages only, or of two pages, stay."""
    page = "<body><div class=x7>notice of the {0}</div>{1}<div class=y>{2} own text</div><p>again</p><p>again</p>"
    rows = [(i, "http://h/", page.format("house", "<h4>some</h4>" * (i % 2), f"word{i} " * 9)) for i in range(9)]
    rows += [(20 + i, "http://two/", page.format("house", "", f"word{i}")) for i in range(2)]
    rows += [(30 + i, "http://art/", f"<article><h1>title{i}</h1><div class=x7>subscribe now</div><p>{'t' * i} text</p></article>") for i in range(4)]
    want = [(i, "some\n" * (i % 2) + f"word{i} " * 9 + "own text") for i in range(9)]
    want += [(20 + i, f"notice of the house\nword{i} own text\nagain\nagain") for i in range(2)]
    want += [(30 + i, f"title{i}\n{'t' * i} text".replace("\n ", "\n")) for i in range(4)]
    assert read(spark, ws, rows) == sorted(want, key=repr)
    monkeypatch.setattr(w, "FAN_IN", 2)
    assert read(spark, ws, rows) == sorted(want, key=repr)


def test_every_class_counts(spark, ws):
    page = '<body><div class="a b c d content"><p>main text</p></div><p>x</p><div class="flex mt-4 md:w-1/2 w-full p-2 sidebar">side text of more words</div>'
    assert w.element("div", ' class="z y x w v u"') == "div.u.v.w.x.y.z"
    assert read(spark, ws, [(1, "http://h/", page), (2, None, page)]) == [(1, "main text"), (2, "main text")]


def test_unmarked_pages_lose_link_lists(spark, ws):
    page = "<body><div class=x>{0}</div><div class=y><a>{1}</a> <a>{1}</a></div>"
    rows = [(i, f"https://h.org:80/{i}", page.format("text " * (9 + i), f"link{i}")) for i in range(5)]
    assert read(spark, ws, rows) == [(i, ("text " * (9 + i)).strip()) for i in range(5)]


def test_awkward_rows(spark, ws):
    rows = [
        (1, None, None), (2, "", ""), (3, "no address", "just text &lt;b&gt;"), (4, "http://a/", "<p>a<p>b</div></p>c <b>d"),
        (4, "http://a/", "<p>a<p>b</div></p>c <b>d"), (None, "http://a/", "< 3 <!-- x"), (5, "http://long/", "<p>w</p>" * 20_000),
        (6, "http://deep/", "<div>" * 400 + "deep"),
    ]
    want = [
        (1, ""), (2, ""), (3, "just text <b>"), (4, "a\nb\nc d"), (4, "a\nb\nc d"), (None, "< 3"),
        (5, "\n".join(["w"] * 20_000)), (6, "deep"),
    ]
    assert read(spark, ws, rows, clash=True) == sorted(want, key=repr)
    assert read(spark, ws, []) == []


def test_many_streams_of_a_host_merge_as_a_tree(spark, ws, monkeypatch):
    monkeypatch.setattr(w, "FAN_IN", 4)
    rng = random.Random(2)
    parts = ["<h3>t</h3>", "<ol><li>i</li></ol>", "<p>u</p>", "<blockquote>q</blockquote>", "<table><tr><td>c</td></tr></table>"]
    rows = [(i, "http://one/", f"<article>{''.join(rng.choices(parts, k=rng.randint(1, 9)))}</article>") for i in range(60)]
    got = dict(read(spark, ws, rows))
    assert all(got[i] == "\n".join(re.findall(r">(\w)<", page)) for i, _, page in rows)


@pytest.mark.parametrize(
    "one, two, wrapper",
    [
        (["<p", "#", "</p"], ["<p", "#", "</p"], ["<p", "#", "</p"]),
        (["a", "b", "c"], ["a", "c"], ["a", ["?", ["b"]], "c"]),
        (["a", "x", "x", "x"], ["a", "x"], ["a", ["+", ["x"]]]),
        (["a", ["?", ["b"]], "c"], ["a", "c"], ["a", ["?", ["b"]], "c"]),
    ],
)
def test_wrappers_cover_both(one, two, wrapper):
    assert w.align(w.collapse(one), w.collapse(two)) == wrapper


@pytest.mark.parametrize(
    "one, two, wrapper",
    [
        (["<p", "#x", "</p"], ["<p", "#x", "</p"], ["<p", "#x", "</p"]),
        (["<p", "#x", "</p", "#z"], ["<p", "#y", "</p", "#z"], ["<p", "#", "</p", "#z"]),
        (["a", "#x", "#y"], ["a", "#x"], ["a", ["+", ["#"]]]),
    ],
)
def test_differing_texts_become_slots(one, two, wrapper):
    assert w.align(w.collapse(one), w.collapse(two)) == wrapper


def test_repeats_of_repeats():
    row = ["<tr", "<td", "#", "</td", "<td", "#", "</td", "</tr"]
    assert w.collapse(row * 3) == [["+", ["<tr", ["+", ["<td", "#", "</td"]], "</tr"]]]


def test_custom_elements_and_self_closing_svg(spark, ws):
    text = "<p>first</p>{}<p>second</p>"
    odd = ["<select-box>x</select-box>", "<title-bar/>", "<svg width=1 />", "<svg/>", "<svg><path/></svg>", "<style-guide>", "<script-x></script-x>"]
    pages = [(i, None, f"<body><article>{text.format(o)}</article></body>") for i, o in enumerate(odd)]
    want = [(i, "first\nx\nsecond" if i == 0 else "first\nsecond") for i in range(len(odd))]
    assert read(spark, ws, pages) == want


def test_twenty_thousand_open_elements_take_little_memory():
    import tracemalloc

    page = "<article>" + "".join(f"<div>x{i}" for i in range(20_000))
    tracemalloc.start()
    out, slots = w.stream(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000 and sum(sum(v) for v in slots.values()) == sum(len(f"x{i}") for i in range(20_000))
