import pytest

from civiclens.llm.pages import MAIN, TEMPLATE, blocks

ARTICLE = "<article><h1>T</h1><p>one</p><div class='share'>s</div><nav>n</nav></article>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='site has-sidebar'>{ARTICLE}</div>",
        f"<form action='/'>{ARTICLE}</form>",
        f"<body><nav>{ARTICLE}",
        f"<body><div class='ad'>{ARTICLE}",
        f"<html><head><title>x</title><meta name='a'><body>{ARTICLE}",
        f"<head><title>x</title><link rel='a'>{ARTICLE}",
    ],
)
def test_wrappers_do_not_swallow_the_article(page):
    assert blocks(page) == [(MAIN, "T"), (MAIN, "one"), (TEMPLATE, "s"), (TEMPLATE, "n")]


def test_articles_of_comments_and_hidden_parts_stay_out():
    page = "<article><p>a</p><div class='comments'><article>c</article></div></article><div hidden><article>h</article></div>"
    assert blocks(page) == [(MAIN, "a"), (TEMPLATE, "c"), (TEMPLATE, "h")]
    assert blocks("<head><title>t</title><style>p{}</style></head><div class='ad'>x</div>") == [(TEMPLATE, "x")]
