import pytest

from lodestar.functions import selectors as SEL
from lodestar.operators import htmlrecords as H
from lodestar.sources import files as FS


def found(html, block, **fields):
    fs = [(n, SEL.parse_selector(s), a) for n, (s, a) in fields.items()]
    records, error = SEL.select_records(html, SEL.parse_selector(block), fs)
    assert error is None
    return records


def count(html, block):
    return len(found(html, block))


def test_selectors():
    html = ('<div id=a class="x y"><p class=x>1<p>2</p><ul><li data-k="v w">3<li><a href=u.pdf>4</a></ul></div>'
            '<DIV class="y">5<br/>6<img src=z></DIV><section><div><div class="x">7</div></div></section>')
    for selector, n in (("div", 4), ("*", 13), (".x", 3), (".x.y", 1), ("div.x", 2), ("#a", 1), ("div#a.y", 1), ("div p", 2), ("div > p", 1),
                        ("li a", 1), ("ul > a", 0), ("ul>li a , img", 2), ("[data-k]", 1), ('[data-k="v w"]', 1), ("[data-k=v]", 0),
                        ("[data-k~=w]", 1), ('a[href$=".pdf"]', 1), ("a[href^=u]", 1), ("[href*=x]", 0), ("section > div > .x", 1),
                        ("section > .x", 0), ("div div.x", 1), (".X", 0)):
        assert count(html, selector) == n, selector
    for bad in ("", "a >", "> a", "a:hover", ".", "a,,b", "a[", "a + b"):
        with pytest.raises(ValueError):
            SEL.parse_selector(bad)


def test_first_match_below_the_block_and_whole_texts():
    html = ("<i class=t>out</i><div class=b><div class=b><b class=t>in <u>ner</u></b></div><b class=t>later</b>"
            "<script>var t='<b class=t>';</script><!-- <b class=t>no</b> --></div><div class=b></div>")
    assert [r["t"] for r in found(html, ".b", t=(".t", None))] == ["in ner", "in ner", None]
    assert found("<div><span>a<style>p{}</style>&amp;&nbsp;b<script>c</script></span></div>", "div", t=("span", None)) == [
        {"t": "a&\xa0b"}]
    assert found("<div><a>x</a><a href=y>z</a></div>", "div", h=("a", "href"), t=("a[href]", None)) == [{"h": None, "t": "z"}]
    # a selector may start above the block, the element may not
    assert found("<main><div><p>1</p></div></main>", "div", t=("main p", None), u=("main", None)) == [{"t": "1", "u": None}]


def test_broken_nesting():
    html = "<div class=b><p><b>one</div></span></div><div class=b><h1>two"
    assert [r["t"] for r in found(html, ".b", t=("p, h1", None))] == ["one", "two"]
    deep = "<div>" * 20000 + "<p class=q>x</p>" + "</b>" * 20000
    assert found(deep, ".q", t=("p", None)) == [{"t": None}] and count("<", "div") == count("", "div") == 0


def results_page(n):
    out, want = [], []
    for i in range(n):
        pdf = f'<div class="gs_ggs gs_fl"><div class="gs_ggsd"><div class="gs_or_ggsm"><a href="http://h/{i}.pdf"><span>[PDF]</span> h</a></div></div></div>'
        out.append(f'<div class="gs_r gs_or gs_scl" data-cid="c{i}">{pdf if i % 3 else ""}<div class="gs_ri"><h3 class="gs_rt">'
                   f'<span class="gs_ctc">[BOOK]</span> <a id="c{i}" href="http://h/{i}?a=1&amp;b=2">Title &quot;{i}&quot;, <b>part</b></a></h3>'
                   f'<div class="gs_a">A, B - 20{i:02d}</div><div class="gs_rs">… first line \n{i} <b>second</b>, "line" …</div>'
                   f'<div class="gs_fl gs_flb"><a href="/cite">Cite</a></div></div></div>')
        want.append((f'Title "{i}", part', f"http://h/{i}?a=1&b=2", f'… first line \n{i} second, "line" …', f"http://h/{i}.pdf" if i % 3 else H.NO_PDF))
    return f"<html><body><div id=gs_res_ccl>{''.join(out)}</div></body></html>", want


def test_result_page_to_csv_and_back(spark, tmp_dir):
    html, want = results_page(20)
    pages = spark.createDataFrame([(1, html, "x"), (2, "<p>none</p>", "x"), (3, None, "x"), (4, "", "x")], "page_id long, html string, title string")
    got = H.select_records(pages)
    assert got.columns == ["page_id", "pos", *H.RECORD_FIELDS, "error"]
    rows = got.orderBy("pos").collect()
    assert [tuple(r[2:6]) for r in rows] == want and {r["error"] for r in rows} == {None} and [r["pos"] for r in rows] == list(range(20))
    FS.write_csv(got.select(*H.RECORD_FIELDS), tmp_dir + "/csv")
    back = FS.read_csv(spark, tmp_dir + "/csv", ", ".join(f"{c} string" for c in H.RECORD_FIELDS), multi_line=True)
    assert sorted(tuple(r) for r in back.collect()) == sorted(want)
    assert H.select_records(pages.limit(0)).count() == 0
    empty = '<div class="gs_r gs_or gs_scl"><h3 class="gs_rt"><a></a></h3></div>'
    one = H.select_records(spark.createDataFrame([(1, empty)], "page_id long, html string")).first()
    assert (one["title"], one["link"], one["snippet"]) == ("", H.NO_LINK, H.NO_SNIPPET)


def test_unreadable_mark_up_is_reported(spark):
    df = spark.createDataFrame([(1, "<div class=b>x</div><![bad[ y"), (2, "<![bad[ y")], "page_id long, html string")
    got = {r["page_id"]: r for r in H.select_records(df, ".b", {"t": ("p", None, "-")}).collect()}
    assert got[1]["t"] == "-" and (2 not in got or got[2]["error"])
