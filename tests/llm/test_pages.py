from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakewarden.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li>One<li>Two</ul></nav><div class="ad-box">Buy now</div><div id="sidebar"><p>side</p></div>
<article><header>by line</header><h1>Title &amp; more</h1><p><b>First&nbsp;line<br>goes on<p>Second   para &lt;x&gt; &#233;<!-- no -->end
<div class="notice">cookies</div><form><input><button>Go</button></form><blockquote>Said</blockquote><section class="comments"><p>reader</p></section>
<ul><li>a</li><li>b</li></ul></article><aside>more</aside><footer>&copy; x</footer>"""


def test_article_blocks():
    text, loose, other = html_text.blocks(PAGE)
    assert text == ["Title & more", "First line goes on", "Second para <x> éend", "Said", "a", "b"]
    assert loose == [False, False, False, False, True, True]
    assert "Buy now" in other and "reader" in other and "cookies" in other and "by line" in other


@pytest.mark.parametrize(
    "page,want",
    [
        ("", []),
        ("plain text", ["plain text"]),
        ("<p>a<p>b</div>c", ["a", "b", "c"]),
        ("<main><p>x</main><p>y", ["x"]),
        ("<div role=main>x</div>y", ["x"]),
        ("<p>1 < 2 &unknown; &#x41;</p>", ["1 < 2 &unknown; A"]),
        ("<article><p>cut off here", ["cut off here"]),
        ("<div hidden>no</div><p style='display:none'>no</p>yes", ["yes"]),
        ("<script>if (a<b) x</script>t<style>", ["t"]),
        ("<a title='a > b'>link</a> text <i>it</i>alic", ["link text italic"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ],
)
def test_odd_markup(page, want):
    assert html_text.blocks(page)[0] == want


@pytest.mark.parametrize(
    "page,want",
    [
        ("<main class='has-sidebar'><p>x</main><div class='sidebar'>s</div>", ["x"]),
        ("<article class='post category-search'><h1 class='entry-header'>T</h1><p>x</article>", ["T", "x"]),
        ("<article class=search><h2 class=header>T</h2><p>x</article>", ["T", "x"]),
        ("<div class='widget'>side<article><p>x<div class=share>no</div></article></div><p>y", ["x"]),
        ("<div class='related'><article>teaser</article></div><article>x</article>", ["x"]),
        ("<div style='overflow:hidden'>a</div><p class='no-hidden'>b</p><p class='hidden'>c</p><p data-id=menu>d</p>", ["a", "b", "c", "d"]),
        ("<article hidden>no</article><p aria-hidden=true>no</p><p style='color:red; display: none'>no</p>yes", ["yes"]),
        ("<div class='site-header'>no</div><div id=main-menu>no</div><div class='cookie-banner'>no</div><div class='comment-list'>no</div>yes", ["yes"]),
    ],
)
def test_article_text_is_not_furniture(page, want):
    assert html_text.blocks(page)[0] == want


def test_long_items_of_an_article_stay():
    item = "stir the sauce until it is thick"
    assert html_text.blocks(f"<article><ul><li>{item}</li></ul><div>{item}</div></article>")[1] == [False, True]
    assert html_text.blocks(f"<ul><li>{item}</li></ul>")[1] == [True]


@pytest.mark.parametrize("seed", range(40))
def test_ranks_by_prefix(seed):
    r = np.random.default_rng(seed)
    ids, length = r.integers(0, int(r.integers(1, 5)), int(r.integers(1, 80))), int(r.integers(1, 9))
    keys = [tuple(ids[i : i + length]) for i in range(len(ids))]
    want = sorted(keys)
    assert [want.index(k) for k in keys] == html_text.suffix_order(ids, length).tolist()


def test_boilerplate_of_a_host(spark, rows):
    menu = "<div>home news sport weather about us contact</div>"
    pages = [(i, "http://a.example/x", f"{menu}<div>{' '.join(f'w{i}x{j}' for j in range(9))}</div>") for i in range(3)]
    pages += [(10, "http://b.example/", f"{menu}<div>only here</div>")]
    same = "<article><p>a paragraph that two pages of the host both have</p><div>share this page with all of your friends</div><p>p{}</p></article>"
    pages += [(20 + i, "http://c.example/", same.replace("{}", str(i))) for i in range(2)]
    pages += [(30, None, None), (None, "odd", "<p>null id</p>"), (31, "http://c.example", ""), (20, "http://c.example/", same.replace("{}", "0"))]
    got = html_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)))
    text = {(r["page_id"], r["url"]): r["text"] for r in got.collect()}
    assert text[0, "http://a.example/x"] == " ".join(f"w0x{j}" for j in range(9))
    assert text[10, "http://b.example/"] == "home news sport weather about us contact\nonly here"
    assert text[20, "http://c.example/"] == "a paragraph that two pages of the host both have\np0"
    assert text[30, None] == "" and text[None, "odd"] == "null id"
    assert got.count() == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got.collect())


def test_runs_are_found_across_shards(spark, rows):
    """A page's text does not depend on the number of shards: a notice on two pages of many goes, wherever they are."""
    own = lambda i: f"<div>{' '.join(f'w{i}x{j}' for j in range(9))}</div>"
    notice = "<div>this rare notice stands on two pages only</div>"
    pages = [(i, f"http://a.example/{i}", own(i) + (notice if i in (3, 17) else "") + "<div>home news sport weather about us contact</div>") for i in range(20)]
    pages += [(30 + i, "http://b.example/", own(30 + i) + "<div>home news sport weather about us contact</div>" * (i == 0)) for i in range(3)]
    pages += [(40, "http://a.example/40", "<div>equal pages are one and keep their text</div>"), (41, "http://a.example/41", "<div>equal pages are one and keep their text</div>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    whole, dealt = (rows(html_text.main_text(frame, per_shard=n)) for n in (64, 1))
    assert whole == dealt
    text = {r[0]: r[2] for r in dealt}
    assert text[3] == " ".join(f"w3x{j}" for j in range(9)) and text[30].endswith("contact") and text[40].startswith("equal")


def test_no_pages(spark):
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("bad", ['<a "x ', "<!", "<div>", "</x>", "<b>x<p></p>", "<noscript><", "\"'> <a ", "<a '> ", "<div>x"])
def test_broken_pages_take_time_in_proportion(bad):
    seconds = []
    for size in (100_000, 800_000):
        start = time.process_time()
        html_text.blocks(bad * (size // len(bad)))
        seconds.append(time.process_time() - start)
    assert seconds[1] < 24 * max(seconds[0], 0.05)  # the square would be 64 times as much


def test_tags_cut_off_and_quotes_left_open():
    assert html_text.blocks('<p>cut <b class="x')[0] == ["cut"]
    assert html_text.blocks("<p>kept</p><!-- never closed <p>gone")[0] == ["kept"]
    assert html_text.blocks("<p>kept</p><!doctype")[0] == ["kept"]
    # an open quote: from this tag on a tag ends at the next >
    assert html_text.blocks('<article><p>one <a href="x>two</a> three <i title=y>four</i></p></article>')[0] == ["one two three four"]
    assert html_text.blocks("<p>3 < 4 and a<3</p>")[0] == ["3 < 4 and a<3"]


def test_pages_are_parsed_once_for_all_steps_of_a_host(spark):
    """Pages are read for their own text, and once more, with their windows, for what shards of a host share."""
    pages = spark.createDataFrame([(0, "http://a/b", "<p>x</p>")], "page_id long, url string, html string")
    assert html_text.main_text(pages)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 3
