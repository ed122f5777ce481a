from tidemark.llm import html_main as H

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>
<header><a href="/">Site</a> slogan</header><div id="cookie-notice">We use cookies</div>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><aside class="sidebar">Links of the day</aside>
<{tag} {attr}><h1>Title {i}</h1><p>First <b>bold</b>ly&nbsp;said &amp; done {i} {more}<p>Second<br>line &#233;&eacute; {i}
<div class="ad-box ad">Buy now {i}</div><script>var x = "<p>no</p>";</script><!-- <p>no</p> -->
<table><tr><td>cell {i}<td>two</table><form>Mail <input> <button>Go</button></form></{tag}>
<section class="comments"><p>reader {i} says hello</p></section><footer>&copy; 2024 {i}</footer></body></html>"""


def page(i, tag="article", attr="", more="with many more words that differ from page to page"):
    return PAGE.format(i=i, tag=tag, attr=attr, more=more + f" {i * 7}")


def want(i):
    return f"Title {i} First boldly said & done {i} with many more words that differ from page to page {i * 7} Second line éé {i} cell {i} two"


def test_main_text_of_marked_and_unmarked_layouts():
    for tag, attr in (("article", ""), ("main", ""), ("div", 'class="content"')):
        assert H.extract_run([page(i, tag, attr) for i in range(12)]) == [want(i) for i in range(12)]
    assert H.extract_run([page(3)]) == [want(3)]


def test_constant_slots_go_and_copies_stay():
    boxed = [page(i, "div").replace("<table>", "<blockquote>Follow us everywhere</blockquote><table>") for i in range(20)]
    assert H.extract_run(boxed) == [want(i) for i in range(20)]
    assert H.extract_run([page(1)] * 30) == [want(1)] * 30


def test_markup_of_any_depth():
    deep = "<html><body><article><p>start</p>" + "<div>" * 10_000 + "<p>at the bottom</p>" + "</div>" * 10_000 + "<p>end</p></article></body></html>"
    assert H.extract_run([deep, deep, page(1)])[:2] == ["start at the bottom end"] * 2
    assert H.extract_run(["<div>" * 30_000 + "never closed"]) == ["never closed"]


def test_broken_markup_and_no_markup():
    got = H.extract_run([None, "", "just text &lt; 5", "<p>a<p>b<b>c</p>d", "<div><div><article>x <i>y</i>z", "</p></div>q", "<a href='>' title=\"a>b\">l</a> r <br/>s", "<" * 50, "<script>never closed"])
    assert got[:3] == ["", "", "just text < 5"] and got[3] == "a bc d" and got[4] == "x yz" and got[8] == ""
    assert got[6] == "l r s"


def test_query_rows(spark):
    rows = [(i, f"http://h{i % 3}.example.org/{i}", page(i)) for i in range(40)] + [(None, None, None), (41, "not a url", ""), (5, "http://h2.example.org/5", page(5))]
    rows = [(*r, "x", 4) for r in rows]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, mark int")
    out = H.main_text(df).collect()
    assert len(out) == 43 and all(r.n_chars == len(r.text) for r in out)
    got = {r.page_id: r.text for r in out}
    assert all(got[i] == want(i) for i in range(40)) and got[None] == "" and got[41] == ""
    assert H.main_text(df.limit(0)).count() == 0


def test_alignment_is_simple_tree_matching():
    top = H.Slot(("#root", ""))
    first = H.layout([H.parse("<div><p>a</p><ul><li>x</ul></div>")])
    H.align(first, top, {})
    second = H.layout([H.parse("<div><h2>t</h2><p>a</p><p>b</p><ul><li>x<li>y</ul></div>")])
    assert H.weight(second, top, {})[0] == 4  # div, p, ul, li; h2 has no partner
    H.align(second, top, {})
    assert [s.kind[0] for s in top.kids[0].kids] == ["h2", "p", "ul"]
