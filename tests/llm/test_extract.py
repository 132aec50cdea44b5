import time

import pytest
from tabularium.llm.extract import main_text

BODY = "A first paragraph that is long enough to look like prose, with commas and an end."
MORE = "The second paragraph goes on about the same thing for a good while, as prose does."


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><article><h1>T &amp; U</h1><p>{BODY}</p>"
         f"<p>{MORE}</p></article><footer>&copy; f</footer></body></html>", f"T & U\n\n{BODY}\n\n{MORE}"),
        (f"<body><div id=sidebar><p>{MORE}</p></div><div class=content><h2>Head</h2><div><p>{BODY}</p><p>{MORE}</p></div>"
         f"<div><p>{BODY}</p></div></div><section class='user-comments'><p>{MORE}</p></section></body>",
         f"Head\n\n{BODY}\n\n{MORE}\n\n{BODY}"),
        (f"<main><div class='cookie-notice'>{BODY}</div><p>{BODY}<br>{MORE}<aside>{MORE}</aside></main>", f"{BODY} {MORE}"),
        (f"<article><form>Name <input><p>{MORE}</form><p>{BODY}<script>if (a < b) {{ x('</p>') }}</script></article>", BODY),
        (f"<article><p><b>{BODY}<br><p>{MORE}</p></article>", f"{BODY}\n\n{MORE}"),
        (f"<article><header><h1>Own</h1><span>by me</span></header><p>{BODY}</p>"
         f"<article class=comment><p>{MORE}</p></article></article>", f"Own\n\n{BODY}"),
        (f"<main><article><p>{BODY}</p><p>{MORE}</p></article><div><p>{BODY}</p></div></main>", f"{BODY}\n\n{MORE}"),
        (f"<div class='page has-sidebar'><div id=sideBar><p>{MORE}</p></div><div><p>{BODY}</p><p>{MORE}</p></div></div>",
         f"{BODY}\n\n{MORE}"),
        (f"<ul><li>one<li>two &lt;b&gt;</ul><p>{BODY}", f"one\n\ntwo <b>\n\n{BODY}"),
        (f"<!-- <p>no</p> --><p>  a\n\t b&nbsp;c  </p><!-- open {BODY}", "a b c"),
        ("2 < 3 and <3", "2 < 3 and <3"),
        ("<p title='broken>text</p>", "text"),
        ("", ""),
        (None, ""),
    ],
)
def test_layouts(html, text):
    assert main_text(html) == text


def test_depth_and_length_are_no_concern():
    assert main_text("<div>" * 20_000 + BODY + "</div>" * 20_000) == BODY
    assert len(main_text(f"<article><p>{'word ' * 200_000}</p></article>")) == 5 * 200_000 - 1


@pytest.mark.parametrize(
    "inner",
    [
        "<section class='related-work'><p>{}</p></section>",
        "<section id='share-prices'><p>{}</p></section>",
        "<div class='skip-level'><p>{}</p></div>",
        "<section id='comment-on-policy'><p>{}</p></section>",
        "<p><math><mi>{}</mi></math></p>",
        "<p><button>{}</button></p>",
        "<dialog open><p>{}</p></dialog>",
    ],
)
def test_text_of_the_article_stays(inner):
    html = f"<body><nav><a href=x>menu</a></nav><article><p>{BODY}</p>{inner.format(MORE)}</article></body>"
    assert main_text(html) == f"{BODY}\n\n{MORE}"


@pytest.mark.parametrize(
    "name",
    "related-posts share-buttons skip-link skip-to-content comment-list user-comments cookie-consent site-footer ad ads-top "
    "social-links newsletter-signup sign-up-form mainNav header-bar advertisement sidebar-left widget-area notice".split(),
)
def test_named_boilerplate_goes(name):
    for attribute in ("class", "id"):
        html = f"<body><article><p>{BODY}</p><div {attribute}='{name}'><p>{MORE}</p></div></article></body>"
        assert main_text(html) == BODY
    assert main_text(f"<article><p>{BODY}</p><dialog><p>{MORE}</p></dialog></article>") == BODY


def test_broken_markup_takes_time_in_proportion():
    shapes = {
        "deep": lambda n: "<div>" * n + BODY,
        "stray ends": lambda n: "<span>" * n + "</b>" * n + BODY,
        "blocks in inline": lambda n: "<span>" * n + "<p>x" * n,
        "bodies": lambda n: "<body><i>" * n + BODY,
        "rows": lambda n: "<table><tr><td><b>" * n + BODY,
    }

    def took(html: str) -> float:
        start = time.process_time()
        main_text(html)
        return time.process_time() - start

    for name, shape in shapes.items():
        small = min(took(shape(5_000)) for _ in range(2))
        assert took(shape(40_000)) < 30 * small + 0.2, name
