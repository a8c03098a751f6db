import os
import time

import pytest

from matchweave.llm.html_text import extract_text, main_text
from tests.llm.data import frame

LONG = "A sentence of the article, with some words; and more of them. Another one follows, as long as this."


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x:"</p>"}}</style><script>var a="<p>no</p>";</script></head>
    <body class="has-sidebar"><header>Site name</header><nav><ul><li><a href="/a">Menu</a><li><a>More</a></ul></nav>
    <div class="cookie-notice">We use cookies. {LONG}</div><!-- <p>gone</p> --><div id="sideBar"><p>{LONG}</p></div>
    <article class="post comments-open"><h1>A &amp; B</h1><p><b>First
      line<br>goes on<p>{LONG} 1 &lt; 2&nbsp;!</p><form><p>Your name</p></form><ul><li>one<li>two</ul>
    <div class="ad">Buy! {LONG}</div><aside>{LONG}</aside></article>
    <section class="comments"><p>Reader says: {LONG}</p></section><footer>&copy; {LONG}</footer>"""
    assert main_text(page) == f"A & B\nFirst line goes on\n{LONG} 1 < 2 !\none\ntwo"


def test_content_without_article_element():
    menu = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(8))
    page = f'<body><div><ul>{menu}</ul></div><div class="content"><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div></body>'
    assert main_text(page) == f"Head\n{LONG}\nShort.\n{LONG}"


def test_broken_and_empty_pages():
    assert main_text(None) == main_text("") == main_text("<html><script>x") == main_text("<nav>a</nav>") == ""
    assert main_text("plain < text & more") == "plain < text & more"
    assert main_text("<p>a <b>b</p><p>c") == "a b\nc"
    assert main_text("<p title='>'>x</p><p foo=\"bar>y") .startswith("x")
    assert main_text("<div>" * 3000 + "deep") == "deep"


def test_every_row_is_answered(spark):
    rows = [(1, "u", "<p>x é</p>"), (1, "u", "<p>x é</p>"), (None, None, None)]
    pages = frame(spark, rows, "page_id bigint, url string, html string", extra=True)
    got = extract_text(pages).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "x é", 3)] * 2 + [(None, None, "", 0)], key=str)
    assert extract_text(pages.limit(0)).count() == 0


def test_marks_in_the_names_of_wrappers():
    article = f"<article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></article>"
    side = f'<div class="sidebar"><p>Side: {LONG}</p></div><div class="comments"><p>Reader: {LONG}</p></div>'
    want = f"Head\n{LONG}\n{LONG}"
    for name in ("has-sidebar", "layout no-sidebar", "elementor-widget-text-editor", "with-comments", "social page"):
        assert main_text(f'<body><div class="{name}">{article}{side}</div></body>') == want, name
        assert main_text(f'<body><div id="{name}">{article}</div>{side}</body>') == want, name
        assert main_text(f'<div class="{name}"><div class="widgets"><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div></div>') == want, name
    parts = "".join(f'<div class="elementor-widget-text-editor"><p>{i} {LONG}</p></div>' for i in range(5))
    assert main_text(f"<body>{parts}</body>") == "\n".join(f"{i} {LONG}" for i in range(5))
    assert main_text(f'<form id="aspnetForm"><div>{article}</div></form>') == want


def test_long_comments_beside_an_article():
    article = f'<article class="post comments-open"><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></article>'
    reader = "".join(f'<li><article class="comment"><p>Reader {i}: {LONG}</p></article></li>' for i in range(9))
    page = f'<div class="has-sidebar">{article}<div id="comments"><ol>{reader}</ol></div></div>'
    assert main_text(page) == f"Head\n{LONG}\n{LONG}"


def test_no_part_of_the_content_is_dropped():
    two = f"<body><nav><a>Menu</a></nav><article><h2>One</h2><p>{LONG} {LONG}</p></article><article><h2>Two</h2><p>{LONG}</p></article></body>"
    assert main_text(two) == f"One\n{LONG} {LONG}\nTwo\n{LONG}"
    body = "".join(f"<p>{i} {LONG}</p>" for i in range(8))
    lines = "\n".join(f"{i} {LONG}" for i in range(8))
    page = f'<body><div class="lead"><h1>Title</h1><p>Lead: {LONG}</p></div><div class="text">{body}</div><div class="end"><p>End: {LONG}</p></div></body>'
    assert main_text(page) == f"Title\nLead: {LONG}\n{lines}\nEnd: {LONG}"
    assert main_text(f"<body><div><h1>Title</h1></div><div>{body}</div></body>") == f"Title\n{lines}"


def test_link_lines_of_the_article_stay_and_menus_go():
    body = "".join(f"<p>{i} {LONG}</p>" for i in range(8))
    lines = "\n".join(f"{i} {LONG}" for i in range(8))
    sources = "<ul>" + "".join(f'<li><a href="/{i}">Source {i}</a></li>' for i in range(12)) + "</ul>"
    listed = "\n".join(f"Source {i}" for i in range(12))
    for outer in ("article", "div"):
        assert main_text(f"<body>{sources}<{outer}>{body}{sources}</{outer}>{sources}</body>") == f"{lines}\n{listed}"
    assert main_text(f"<body>{sources}{body}{sources}</body>") == lines


def test_a_sidebar_beside_a_wrapper_named_after_it():
    body = "".join(f"<p>{i} {LONG}</p>" for i in range(4))
    lines = "\n".join(f"{i} {LONG}" for i in range(4))
    side = f'<div class="sidebar"><p>Side: {LONG}</p></div>'
    for page in (f'<div class="has-sidebar">{body}{side}</div>', f'<div class="has-sidebar">{body}</div>{side}'):
        assert main_text(f"<body>{page}</body>") == lines


TEMPLATES = {
    "story": '<nav><a>Home</a></nav><div class="story"><h1>T</h1>{body}</div><div class="comments">{reader}</div><footer>F {long}</footer>',
    "column": '<div id="top-menu"><a>A</a><a>B</a></div><div class="cols"><div class="c1">{body}</div><div class="widget-area"><p>Side {long}</p></div></div>{reader_ol}',
    "table": '<table><tr><td class="sidebar">Links {long}</td><td>{body}</td></tr></table><div class="cookie-banner">{long}</div>',
    "main": '<main>{body}<div class="promo"><p>Buy {long}</p></div></main><section id="respond"><form><p>Write {long}</p></form></section>',
    "wiki": '<div id="content" class="mw-body"><div id="toc" class="toc"><ul><li><a>1</a></li><li><a>2</a></li></ul></div>{body}</div><div class="notice">{long}</div>',
    "flat": '<div class="newsletter-signup">Sign up. {long}</div><h1>T</h1>{body}<div class="related-posts"><p>More {long}</p></div><div class="disqus_thread">{reader}</div>',
}


@pytest.mark.parametrize("name", TEMPLATES)
def test_templates_without_article_elements(name):
    """What surrounds the text is longer than it."""
    body = "".join(f"<p>{i} {LONG}</p>" for i in range(3))
    reader = "".join(f'<div class="c"><b>Reader {i}</b><p>I think: {LONG} {LONG}</p></div>' for i in range(12))
    ordered = "<ol class='commentlist'>" + "".join(f"<li><p>Reader: {LONG} {LONG}</p></li>" for i in range(12)) + "</ol>"
    page = TEMPLATES[name].format(body=body, reader=reader, reader_ol=ordered, long=f"{LONG} {LONG}")
    title = "T\n" if "<h1>" in page else ""
    wanted = title + "\n".join(f"{i} {LONG}" for i in range(3))
    assert main_text(f"<body>{page}</body>") == wanted
    assert main_text(f"<body>{page}</body>", strictness=0) != wanted  # the thresholds decide


def test_thresholds_decide_on_given_pages(spark):
    folder = "/root/testdata/sf0.01/pages.parquet"
    if not os.path.exists(folder):
        pytest.skip("no tables")
    pages = [r.html for r in spark.read.parquet(folder).select("html").collect() if r.html]
    changed = sum(main_text(p) != main_text(p, strictness=0) for p in pages)
    assert changed > 0.9 * len(pages)


def test_nesting_costs_no_more_than_its_length():
    start = time.process_time()
    assert main_text("<div>x" * 50_000 + "<p>deep</p>").endswith("x\ndeep")
    assert main_text("<div>" * 600 + "in" + "</div>" * 600 + f"<p>{LONG}</p>") == f"in\n{LONG}"
    assert time.process_time() - start < 20


def test_a_short_article_beside_a_long_advert():
    assert main_text(f'<body><div class="ad">{LONG} {LONG} {LONG}</div><article><h1>Short.</h1></article></body>') == "Short."
