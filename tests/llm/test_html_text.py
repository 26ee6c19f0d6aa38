import pytest

from depotflow.llm.html_text import extract, main_text, stretches

CASES = {
    "": "",
    "just text": "just text",
    "<p>a &lt; b &amp;amp; c&nbsp;&#233;</p>": "a < b &amp; c é",
    "<nav><a href=x>menu</a></nav><article><h1>T</h1><p>one<br>two\n three<p>four</article><footer>f</footer>": "T\n\none two three\n\nfour",
    "<header>Site</header><main><article><header><h1>Title</h1></header><p>One.<div class='ad-box ad'>buy</div><p>Two.</p>"
    "</article><section id=comments><p>a very long reader comment indeed</p></section></main>": "Title\n\nOne.\n\nTwo.",
    "<div id='header'>S</div><div class=sidebar><ul><li><a href=1>x</a><li><a href=2>y</a></ul></div><div><p>Body text one.</p>"
    "<p>Body text two.</p></div><div class='cookie notice'>We use cookies</div>": "Body text one.\n\nBody text two.",
    "<nav>left open<article><p>Body</p></article>": "Body",
    "<article><p>x</p><form><input><p>mail</p></form><script>if (a<b) {'</p>'}</script><style>p{}</style><p>y</p></article>": "x\n\ny",
    "<article><p>Before</p><!-- <p>no</p> --><aside>side</aside><p>After <a href='a>b'>link</a></p></article>": "Before\n\nAfter link",
    "<p>unclosed <b>bold <i>text": "unclosed bold text",
    "<nav><p>only a menu</p></nav>": "",
    "<article></article><p>Outside only.</p>": "Outside only.",
    "a < b <c": "a < b <c",
}


@pytest.mark.parametrize("html", list(CASES))
def test_pages(html):
    assert main_text(html) == CASES[html]


def test_null_and_long_pages():
    assert main_text(None) == ""
    page = "<nav>n</nav><article>" + "<p>word &amp; word</p>" * 20_000 + "</article>"
    assert main_text(page).count("word & word") == 20_000
    assert main_text("<a " * 20_000) == ("<a " * 20_000).strip()
    assert main_text('<p title="' + "x>" * 20_000) == "x>" * 19_999


def test_surge_and_dive():
    assert stretches([]) == [] and stretches([0, 0]) == []
    assert [(a, b) for a, b, _ in stretches([0, 5, 5, 0, 0, 0, 7])] == [(1, 3), (6, 7)]
    assert [(a, b) for a, b, _ in stretches([3, 0, 0, 4])] == [(0, 4)]


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (2, None, None, None)], "page_id long, url string, html string, text string")
    got = sorted(tuple(r) for r in extract(pages).select("page_id", "text").collect())
    assert got == [(1, "a"), (1, "a"), (2, "")] and extract(pages.limit(0)).count() == 0


LONG = "A sentence of the main text, some fifty characters. " * 20

WHOLE = {
    f"<div><p>{LONG}</p><div class=ad>buy</div><p>The last and short paragraph.</p></div>": f"{LONG.strip()}\n\nThe last and short paragraph.",
    "<div><article><p>First story.</p></article><article><p>Second and longer story.</p></article></div>": "First story.\n\nSecond and longer story.",
    "<main><p>Lead text.</p><article><p>The heavier article text.</p></article></main>": "Lead text.\n\nThe heavier article text.",
    "<div class='layout has-sidebar'><p>Body one.</p><div class=sidebar>side</div><p>Body two.</p></div>": "Body one.\n\nBody two.",
    "<div class='main-content no-sidebar'><p>Body.</p></div>": "Body.",
    f"<form id=page><p>{LONG}</p><nav>menu</nav></form><footer>f</footer>": LONG.strip(),
    f"<div class='widget-page'><p>{LONG}</p><div class=cookie>We use cookies</div></div><p>Imprint</p>": LONG.strip(),
    f"<div><p>{LONG}</p></div><div class=comments><p>A comment.</p></div><div><p>Short.</p></div>": LONG.strip(),
}


@pytest.mark.parametrize("html", list(WHOLE), ids=range(len(WHOLE)))
def test_main_text_is_whole(html):
    assert main_text(html) == WHOLE[html]
