"""Pages whose frame is named like boilerplate, and deeply nested pages."""

import pytest

from emporia.llm import html_wrapper

INNER = "<header><p>site</p></header><nav><p>menu</p></nav><article><h1>Head</h1><p>Some words of the article.</p></article><footer><p>end</p></footer>"
WANT = "Head\nSome words of the article."


def extracted(spark, pages):
    frame = spark.createDataFrame([(i, f"http://h{i}.example/", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in html_wrapper.extract(frame).orderBy("page_id").collect()]


def test_frames_named_like_boilerplate_keep_the_article(spark):
    plain = INNER.replace("<article>", "<div>").replace("</article>", "</div>")
    pages = [f'<html><body><form id="aspnetForm">{INNER}</form></body></html>', f'<div class="container with-sidebar">{INNER}</div>',
             f'<div class="site has-header">{INNER}</div>', f'<html class="no-ads"><body>{INNER}</body></html>', f'<div class="header-top">{INNER}</div>',
             f'<form>{plain}</form>', f'<div class="widget"><form class="search"><fieldset>{INNER}</fieldset></form></div>']
    assert extracted(spark, pages) == [WANT] * 6 + [""]


@pytest.mark.parametrize("block", ["form", "div class='comments'", "div class='sidebar'", "div class='related-posts'", "nav", "footer"])
def test_boilerplate_beside_or_without_an_article_stays_out(spark, block):
    tag = block.split()[0]
    other = f"<{block}><article><p>{'Not the article. ' * 20}</p></article></{tag}>"
    assert extracted(spark, [f"<article><p>Text.</p></article>{other}", f"<{block}><p>Sign in here</p></{tag}>"]) == ["Text.", ""]


def test_deep_pages_keep_every_text(spark):
    n = 5000
    deep = "".join(f"<div><p>a{i}</p>" for i in range(n)) + "</div>" * n
    hidden = "<div>" * 1200 + "<p>in</p><nav><p>menu</p></nav><p>more</p>" + "</div>" * 1200
    got = extracted(spark, [deep, hidden, "<ul><li>" * 1500 + "x"])
    assert got == ["\n".join(f"a{i}" for i in range(n)), "in\nmore", "x"]
