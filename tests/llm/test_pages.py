"""Pages that leave out what HTML lets them leave out."""

import pytest

from claimstream.llm import pages

MAIN = "<article><h1>Title here</h1><p>First sentence of it. Second one.</p><p>More of the text.</p></article>"
WHOLE = f"<html><head><title>t</title><style>p {{}}</style></head><body><nav>menu</nav>{MAIN}</body></html>"


def blocks(html):
    return [text for _, text in pages.Page(html).blocks()]


@pytest.mark.parametrize(
    "html",
    [
        WHOLE.replace("</head>", ""),
        WHOLE.replace("</head><body>", ""),
        WHOLE.replace("</head>", "<noscript><img src=x>"),
        WHOLE.replace("<nav>", '<svg class="logo"/><nav>'),
        WHOLE.replace("<h1>", '<h1><svg viewBox="0 0 1 1" />'),
        WHOLE.replace("</head><body>", "<svg/>"),
    ],
)
def test_the_text_of_the_body_is_kept(html):
    assert blocks(html) == blocks(WHOLE) == [
        "menu", "Title here", "First sentence of it. Second one.", "More of the text."
    ]
    extractor = pages.fit([WHOLE] * 5)
    text, whole = extractor.texts([html, WHOLE])
    assert text == whole and "First sentence" in text


BODY = "<h1>Title here</h1><p>First sentence of it. Second one.</p><p>More of the text. It goes on.</p>"
TEXT = "Title here\nFirst sentence of it. Second one.\nMore of the text. It goes on."
AROUND = '<html><body><nav><a href="/">menu</a></nav>{}<footer>Some rights are kept</footer></body></html>'


@pytest.mark.parametrize(
    "article",
    [
        f"<ARTICLE CLASS='x'>{BODY}</ARTICLE >",
        f"<main>{BODY}</main>",
        f'<div role="main">{BODY}</div>',
        f'<div class="text">{BODY}</div>',
    ],
)
def test_pages_teach_their_article_however_it_is_marked(spark, article):
    page = AROUND.format(article)
    assert pages.fit([page] * 5).texts([page]) == [TEXT]
    table = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")
    rows = pages.extracted(table, "html", pages.train(table, "page_id", "html")).orderBy("page_id").collect()
    assert [r.text for r in rows] == [TEXT, "", ""]


def test_pages_that_mark_an_article_come_before_others(spark, monkeypatch):
    monkeypatch.setattr(pages, "TRAIN_PAGES", 2)
    taught = []
    monkeypatch.setattr(pages, "fit", taught.extend)
    forms = ["<div>a. b.</div>", "<main>c.</main>", "<Article>d.</Article>", "<p>e.</p>"]
    table = spark.createDataFrame(list(enumerate(forms)), "page_id int, html string")
    pages.train(table, "page_id", "html")
    assert sorted(taught) == ["<Article>d.</Article>", "<main>c.</main>"]


def test_a_page_without_running_text_teaches_nothing():
    assert pages.fit(["plain text", "", '<ul><li><a href="#">One. Two.</a></li></ul>']) is None


def test_text_ends_a_head_but_a_head_stays_silent():
    assert blocks("<head><title>t</title>\n text <p>more") == ["text", "more"]
    assert blocks("<head><title>t</title><noscript><p>a</p></noscript><template><p>b</p></template></head><p>c") == ["c"]
    assert blocks("<p>a<svg><text>b</text></svg>c") == ["a", "c"]
