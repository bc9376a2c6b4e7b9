"""Layout of pages on hand cases, and all visible text against a plain collector."""

import html as entities
import random
from html.parser import HTMLParser

import pytest

from groundshift.llm import html


def test_layout():
    page = '<html><head><title>x</title></head><body><h1>Head</h1><p>One <b>two</b> &amp; three<p>Four<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><th>N<th>Long name<tr><td>1<td>x<tr><td>100</table><div style="display:none">no</div><pre>a\n  b\n</pre>tail<br>more < 3 <ol start=3><li>x</ol>'
    assert html.render(page) == "Head\n\nOne two & three\n\nFour\n\n- a\n- b\n  - c\n\nN   | Long name\n1   | x\n100\n\na\n  b\n\ntail\nmore < 3\n\n3. x"


def test_breaks_spans_and_cells_of_several_lines():
    assert html.render("a<br>b<br><br>c") == "a\nb\n\nc"
    assert html.render("<table><tr><td colspan=2>title<td>x<tr><td>a<td>bb<td>c</table>") == "title  | x\na | bb | c"
    assert html.render("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>") == "a | b\n  | c\nd | e"
    assert html.render("<table><tr><td>a<ul><li>x<li>y</ul><td>z</table>") == "a   | z\n\n- x\n- y"
    assert html.render("<table><tr><td>a<table><tr><td>p<td>q<tr><td>r<td>s</table><td>z</table>") == "a     | z\n\np | q\nr | s"
    long = "w" * 300
    assert html.render(f"<table><tr><td>a<td>b<tr><td>{long}<td>c<tr><td>abc<td>d</table>") == f"a   | b\n{long} | c\nabc | d"


def test_visibility_is_inherited_and_may_return():
    page = '<div style="visibility:hidden">no<p>no<b style="visibility: visible">yes</b><img alt=no></div><p hidden>no<b style="visibility:visible">no</b></p><noscript>no</noscript>end'
    assert html.render(page).split() == ["yes", "end"]


@pytest.mark.parametrize("page", ["", "<", "<p", "</", "<!--", "<script>x", "a<b", "<table><td>x</table></table>", "<div>" * 30_000 + "deep" + "</div>" * 10, "</p></div><li>x", "<a href='x>y</a>z", "<td>" * 500, "<ul><li>" * 3000 + "deep", "<table><tr><td>" * 1500 + "deep", "<td colspan=99999 rowspan=-1>x", "<b>" * 30_000 + "<p>x" * 100])
def test_never_fails(page):
    text = html.render(page)
    assert "deep" in text if "deep" in page else isinstance(text, str)


def test_rows(spark):
    df = spark.createDataFrame([(1, "<p>a", "t"), (2, None, "t"), (3, "", "t"), (4, "<p>so it is</p>" * 50_000, "t"), (1, "<p>a", "t")], "page_id bigint, html string, text string")
    got = sorted((r.page_id, r.text) for r in html.extracted(df).where("page_id <> 2").collect())
    assert got == [(1, "a"), (1, "a"), (3, ""), (4, "\n\n".join(["so it is"] * 50_000))]
    assert [r.text for r in html.extracted(df).where("page_id = 2").collect()] == [None]
    assert html.extracted(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, words",
    [
        ("<table><tr><td>x</td></tr><div>note</div></table>", "note x"),
        ("<table><tr>Hello<td>x</td></tr></table>", "Hello x"),
        ("<table><tr>stray</tr><b>bold</b><div>divtext</div></table>", "stray bold divtext"),
        ("<table><tbody>a<tr><td>x<td>y<caption>c</caption></table>end", "c a x | y end"),
        ("<table>p<b>q</b><tr><td>x<table><tr>in<td>n</table></table>", "pq x in n"),
        ("<table><form><tr><td>x</td></tr>f</form></table>", "f x"),
        ("<p>a<textarea>b &amp; c</textarea><select><option>d<option>e</select><math><mi>f</mi></math><svg><text>g</text></svg><i aria-hidden=true>h</i>", "ab & c d e fgh"),
        ("<table><tr><td>x</td></tr><div hidden>no</div><script>no</script></table>", "x"),
    ],
)
def test_keeps_all_visible_text(page, words):
    assert " ".join(html.render(page).split()) == words


class Collector(HTMLParser):
    """Characters of the text of well-formed pages outside what has no box or is not visible."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.text = [(False, True)], []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        gone, seen = self.open[-1]
        style = a.get("style") or ""
        gone = gone or tag in html.HIDDEN or "hidden" in a or "display:none" in style
        seen = "visibility:visible" in style if "visibility:" in style else seen
        if tag == "img" and a.get("alt") and not gone and seen:
            self.text.append(a["alt"])
        if tag not in html.VOID:
            self.open.append((gone, seen))

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if not self.open[-1][0] and self.open[-1][1]:
            self.text.append(data)


def plain(page):
    c = Collector()
    c.feed(page)
    c.close()
    return sorted("".join("".join(c.text).split()))


def characters(text):
    """Without the marks of cells and items, which the pages below do not hold."""
    return sorted(x for x in "".join(text.split()) if x not in "|-.0123456789")


def test_random_trees_keep_all_visible_text():
    rng = random.Random(4)

    def inline(depth):
        kind = rng.choice(["text", "text", "b", "br", "img", "i", "select", "svg"])
        attrs = rng.choice(["", "", "", " hidden", ' style="display:none"', ' style="visibility:hidden"', ' style="visibility:visible"'])
        if kind == "text" or depth > 6:
            return entities.escape("".join(rng.choice("abcdef &<") for _ in range(rng.randint(1, 9))))
        if kind == "br":
            return "<br>"
        if kind == "img":
            return f'<img alt="xyz"{attrs}>'
        if kind == "select":
            return f"<select{attrs}><option>uu</option><option>vv</option></select>"
        return f"<{kind}{attrs}>" + "".join(inline(depth + 1) for _ in range(rng.randint(0, 3))) + f"</{kind}>"

    def block(depth):
        attrs = rng.choice(["", "", "", "", " hidden", ' style="visibility:hidden"', ' style="visibility:visible"'])
        many = lambda f, n=3: "".join(f(depth + 1) for _ in range(rng.randint(0, n)))
        kind = rng.choice(["div", "p", "ul", "ol", "table", "script", "inline", "noscript", "textarea"]) if depth < 6 else "p"
        if kind in ("ul", "ol"):
            return f"<{kind}{attrs}>" + "".join(f"<li>{many(block)}</li>" for _ in range(rng.randint(0, 3))) + f"</{kind}>"
        if kind == "table":
            loose = lambda: rng.choice(["", "", "", "loose", "<b>bold</b>", "<div>dd</div>", "<caption>cap</caption>"])
            row = lambda: f"<tr>{loose()}" + "".join(f"<td{rng.choice(['', ' colspan=2', ' rowspan=3', ' colspan=900'])}>{many(block)}</td>{loose()}" for _ in range(rng.randint(0, 3))) + "</tr>"
            return f"<table{attrs}>{loose()}" + "".join(row() for _ in range(rng.randint(0, 3))) + f"{loose()}</table>"
        if kind in ("script", "noscript", "textarea"):
            return f"<{kind}>xx</{kind}>"
        return many(inline) if kind == "inline" else f"<p{attrs}>{many(inline)}</p>" if kind == "p" else f"<div{attrs}>{many(block)}{many(inline)}</div>"

    bad = []
    for _ in range(400):
        page = "".join(block(0) for _ in range(rng.randint(1, 4)))
        if characters(html.render(page)) != characters("".join(plain(page))):
            bad.append(page)
    assert not bad, min(bad, key=len)


def test_given_pages_keep_all_visible_text(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect():
        words = lambda t: sorted(w for w in t.split() if w not in ("-", "|") and not w.rstrip(".").isdigit())
        assert words(html.render(r.html)) == words(" ".join(plain_words(r.html)))


def plain_words(page):
    c = Collector()
    c.feed(page)
    c.close()
    return " ".join(c.text).split()


def test_text_that_looks_like_layout_is_kept():
    assert html.render("<table><tr><td>x ||<td>|<tr><td>y</table>") == "x || | |\ny"
    assert html.render("<!-->visible<p>x") == "visible\n\nx"
    assert html.render("x<!-- a --!>c") == "xc" and html.render("a<!--->b-->c") == "ab-->c" and html.render("a<!-- -- > -->b") == "ab"
    code = "def f():\n    return 1\n\n\tx = 2"
    assert html.render(f"<pre><code>{code}</code></pre>") == code
    assert html.render(f"<pre>\n<b>{code}</b></pre>after") == f"{code}\n\nafter"
    assert html.render(f"<p>a</p><textarea>\n{code}</textarea>") == f"a\n\n{code}"
    assert html.render("<table><tr><td><pre>a\n  b</pre><td>c</table>") == "a   | c\n  b"
    assert html.render('<form><input type=submit value="Send now"><input type=hidden value=no><input type=checkbox value=no> <input value=me></form>') == "Send now me"
