"""Pages that nest or run on without end."""

import time

from oddsframe.llm import html_wrappers as W
from oddsframe.llm.common import ship_package


def _name(i):
    return "".join(chr(97 + int(c)) for c in str(i))   # names are told apart by their letters


def test_five_thousand_levels(spark):
    ship_package(spark)
    deep = "".join(f"<div class='l{_name(i % 7)}'>t{i} " for i in range(5000)) + "<script>bad()</script><nav>menu <div>inner</div></nav><p>last words</p>" + "</div>" * 5000
    page = f"<html><body><nav>top</nav><article>{deep}</article><footer>end</footer></body></html>"
    want = " ".join(f"t{i}" for i in range(5000)) + " last words"
    assert W.extract(page, W.main_paths(W.fold(W.parse(page)))) == want
    rows = [(1, "http://a.example/1", page), (2, "http://a.example/2", page.replace("last", "other")), (3, "http://a.example/3", "<p>plain</p>")]
    got = {r.page_id: r.text for r in W.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == want and got[2] == want.replace("last", "other") and got[3] == "plain"


def test_ends_below_the_last_level_close_their_group():
    page = "<div>" * 400 + "<b>a</b><p>b</p>c" + "</div>" * 300 + "d" + "</div>" * 100 + "<aside>no</aside>e"
    assert W.extract(page, None) == "a b c d e"


def test_twenty_thousand_differing_blocks_are_aligned_in_near_linear_time():
    def page(skip):
        return "<article>" + "".join(f"<div class='{_name(i % 997)} z{_name(i % 31)}'><p>text {i} {skip}</p></div>" for i in range(20000) if i % 50 != skip) + "</article>"
    t = time.time()
    a, b = W.fold(W.parse(page(1))), W.fold(W.parse(page(2)))
    both = W.align(a, b)
    assert time.time() - t < 60
    keys = lambda items: [x["s"] for x in W._flat(items)]
    inside = keys(both[0]["k"])
    for one in (a, b):   # every group of either page is in the wrapper, in order
        left = iter(inside)
        assert all(k in left for k in keys(one[0]["k"]))
    assert len(inside) < 1.1 * 20000
    assert W.extract(page(1), W.main_paths(both)).startswith("text 0 1 text 2 1")


def test_long_alignment_agrees_with_the_short_one_on_what_it_holds(monkeypatch):
    a = W.fold(W.parse("".join(f"<div class='x{_name(i)}'>t</div>" for i in range(60) if i % 7)))
    b = W.fold(W.parse("".join(f"<div class='x{_name(i)}'>u</div>" for i in range(60) if i % 11)))
    short = W.align(a, b)
    monkeypatch.setattr(W, "CELLS", 10)
    long = W.align(a, b)
    assert sorted(x["s"] for x in long) == sorted(x["s"] for x in short) == sorted({x["s"] for x in a} | {x["s"] for x in b})
    assert sum(x["o"] for x in long) == sum(x["o"] for x in short)
