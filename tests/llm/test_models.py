"""Trained models on the given tables: held-out accuracy, and pages with known main text."""

import html
import re

import pytest

from claimstream.llm import pages
from claimstream.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op4_quality"](spark, FOLDER).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    ordered = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert len(bad) >= 5 and ordered / (len(good) * len(bad)) > 0.95
    assert sum(r.predicted for r in rows if r.quality) / len(good) > 0.97


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language"](spark, FOLDER).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def plain(page):
    """The blocks of the article, cut out with patterns."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = (re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", b)) for b in re.split(r"</?(?:p|h1)[^>]*>", inner))
    folded = (re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(b)).strip(" ") for b in blocks)
    return "\n".join(b for b in folded if b)


def test_main_text_of_the_given_pages(spark):
    given = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html")
    rows = QUERIES["op7_html"](spark, FOLDER).join(given, "page_id").collect()
    assert len(rows) == 250
    for r in rows:
        assert r.text == plain(r.html) and r.n_chars == len(r.text)


@pytest.fixture(scope="module")
def extractor(spark):
    given = spark.read.parquet(f"{FOLDER}/pages.parquet")
    return pages.train(given, "page_id", "html")


BODY = (
    "<h1>Of the heading</h1><p>First paragraph &amp; some  words,\n with a stop. And another one that goes on"
    " for a while, so that it looks like prose does.</p><p>The second paragraph, also of some length; it has"
    " more than one sentence. Here is the other one, no shorter.</p>"
)
TEXT = (
    "Of the heading\nFirst paragraph & some words, with a stop. And another one that goes on"
    " for a while, so that it looks like prose does.\nThe second paragraph, also of some length; it has"
    " more than one sentence. Here is the other one, no shorter."
)


@pytest.mark.parametrize(
    "furniture",
    [
        "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>More</a></li></ul></nav>",
        "<footer>Copyright of the site, all rights reserved.</footer>",
        '<div class="ad">Buy this now. It is cheap, and it is good.</div>',
        '<div class="comments"><p>I liked it a lot. Thank you for writing it down.</p></div>',
        "<script>var x = '<p>no text</p>';</script><style>p {color: red}</style><!-- <p>no</p> -->",
        '<form><label>Name</label><textarea>some text in here</textarea></form>',
        '<div class="cookie-notice"><p>This site has cookies. Say yes to them all.</p></div>',
    ],
)
def test_furniture_before_and_after_goes(extractor, furniture):
    for page in (f"{furniture}<article>{BODY}</article>", f"<article>{BODY}</article>{furniture}"):
        assert extractor.texts([f"<html><body>{page}</body></html>"]) == [TEXT]


def test_unclosed_and_broken_markup(extractor):
    page = "<article><h1>A heading</h1><p><b>One paragraph of words, not closed.<br><p>Two &lt; three &unknown; here, and so on</p>"
    assert extractor.texts([page, "", "<", "<p", "no markup at all"])[:2] == [
        "A heading\nOne paragraph of words, not closed.\nTwo < three &unknown; here, and so on",
        "",
    ]


def test_no_kept_node_below_a_dropped_one(extractor):
    page = pages.Page("<div><div><p>a</p></div><p>b</p></div><p>c</p>")
    at = {t: n for n, t in page.blocks()}
    outer = page.nodes[page.nodes[at["a"]].parent].parent
    logits = {at["a"]: 1.0, at["b"]: -0.5, at["c"]: 1.0, outer: -3.0}
    kept = pages.decode(page, logits)
    assert not kept[outer] and not kept[at["a"]] and kept[at["c"]]
    logits[outer] = -0.5
    kept = pages.decode(page, logits)
    assert kept[outer] and kept[at["a"]] and not kept[at["b"]]
