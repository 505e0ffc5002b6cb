import re
from html import unescape

import pyarrow.parquet as pq

from millrace.llm.htmltext import extract, main_text

LONG = "Some long text <b>bold</b>er with   spaces\nand a newline, long enough to count as the main text of the page."


def test_pages_match_their_articles(spark):
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pandas()
    got = {r.page_id: r for r in extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    for page, html in zip(pages.page_id, pages.html, strict=True):
        inner = re.search(r"<article>(.*)</article>", html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner)]
        want = "\n".join(x for x in parts if x)
        assert got[page].text == want and got[page].n_chars == len(want)


def test_page_without_article():
    page = f"""<html><head><title>x</title></head><body><header><h1>Site</h1></header><div id="cookie-notice">We use cookies on this site, and a lot of them, as you can see here.</div>
<nav>a b c<p>x</nav><div class="sidebar">side text that is long enough to be counted as main text, maybe</div><div class="content"><h1>T &lt; &eacute;</h1><p>{LONG}<p>Second.
<table><tr><td>a</td><td>b</td></tr></table><form>Name</form><div class="comments"><p>a very long comment by a reader who has much to say about all of this</div></div><footer>(c)</footer></body></html>"""
    assert main_text(page) == "T < é\nSome long text bolder with spaces and a newline, long enough to count as the main text of the page.\nSecond.\na b"


def test_awkward_pages(spark):
    assert main_text(None) == main_text("") == main_text("<nav>only a menu</nav>") == ""
    assert main_text("<article>short &amp; x &am</article><p class='cut") == "short & x &am"
    assert main_text("<article><p>a<script>if (a < b) '</p>'</script> b<!-- c --></p></article>") == "a b"
    assert main_text("plain text only " * 10).startswith("plain text only plain")
    rows = [(1, None, None, 1), (1, "u", "<article>x</article>", 2), (None, "v", "<article>" + "<p>y</p>" * 5000, 3)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(r.n_chars for r in got) == [0, 1, 9999]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_scripts_are_no_markup():
    for code in ("for(var i=0;i<n;i++){f(i)}", "if (a<b) {g()}", "<!-- never closed", "x='<p class=\"';", "<![CDATA[ y"):
        for tag in ("script", "STYLE"):
            assert main_text(f"<article><p>a</p><{tag}>{code}</{tag.lower()} ><p>b</p></article>") == "a\nb"
    assert main_text("<article>a<script>b</scripts>c</article>") == "a"


def test_short_texts_and_harmless_names_are_kept():
    menu = "<nav><p>a<p>b<p>c<p>d</nav>"
    assert main_text(f"<body>{menu}<div class=content><p>Roses are red<p>violets too</div>{menu}</body>") == "Roses are red\nviolets too"
    assert main_text(f"<body><div><p>{LONG}</div>{menu}<p>The end.</body>").endswith("page.\nThe end.")
    page = """<h2 id="search-trees">Trees</h2><section id="related-work"><p>Work</section><div class="article-header"><h1 class="header">Title</h1></div><p class="alert">Mind"""
    assert main_text(f"<article>{page}</article>") == main_text(f"<div>{page}</div>") == "Trees\nWork\nTitle\nMind"
    for inside in ('<div class="x related">r</div>', '<ul class="share">s</ul>'):
        assert main_text(f"<article><p>a</p>{inside}</article>") == "a"
    assert main_text('<p>a</p><div id="site-header">h</div><div class="side-menu">m</div>') == "a"


PARA = "<p>A paragraph of the article that is long enough to make the sum of a window surge, as main text does on any page.</p>"
TEXT = PARA[3:-4]


def test_the_window_decides_what_a_menu_is():
    links = "".join(f"<li><a href='/{i}'>Topic {i}</a></li>" for i in range(4))
    for page in (f"<article>{PARA}<ul>{links}</ul>{PARA}</article>", f"<div>{PARA}<ul>{links}</ul>{PARA}</div>"):
        assert main_text(page, window=3) == f"{TEXT}\n{TEXT}"
        assert main_text(page, window=5) == "\n".join([TEXT, *(f"Topic {i}" for i in range(4)), TEXT])
    assert main_text(f"<article><p><a href=x>One link</a></p>{PARA}</article>") == f"One link\n{TEXT}"
    assert main_text(f"<article><h1><a href=x>Title</a></h1>{PARA}<p>Fin.</article>") == f"Title\n{TEXT}\nFin."


def test_the_surge_decides_which_element_is_the_article():
    page = f"<body><article><h3>Teaser</h3><p>Read on</article><ul><li><a href=a>a</a><li><a href=a>b</a><li><a href=a>c</a></ul><div>{PARA}{PARA}<p>Fin.</div></body>"
    assert main_text(page) == f"{TEXT}\n{TEXT}\nFin."
    two = f"<article>{PARA}{PARA}</article><article><p>Mine too!</article><article>{PARA}</article>"
    assert main_text(two) == f"{TEXT}\n{TEXT}\n{TEXT}"
    assert main_text(f"<article>{PARA}</article><p>{TEXT}</p>" + f"<div>{PARA}</div>") == TEXT
    assert main_text(f"<body><div><div>Home</div><div>News</div><div>Sport</div><div>About</div></div><div>{PARA}<p>Fin.</div></body>", window=1) == f"{TEXT}\nFin."


def test_reader_comments_go():
    for comments in (
        f"<section id='comments'><h2>Comments</h2><article class='comment'>{PARA}</article><article>{PARA}</article></section>", f"<article class='comment even'>{PARA}</article>",
        f"<div id='disqus_thread'>{PARA}</div>", f"<ol class='comment-list'><li>{PARA}</li></ol>", f"<article itemprop='comment'>{PARA}</article>", f"<article class='comment-body'>{PARA}</article>",
    ):
        assert main_text(f"<article>{PARA}</article>{comments}") == TEXT, comments
        assert main_text(f"<article>{PARA}{comments}</article>") == TEXT, comments
        assert main_text(f"<div class='content'>{PARA}</div>{comments}") == TEXT, comments
    assert main_text(f"<article class='post comments-open'>{PARA}</article>") == TEXT
    assert main_text(f"<article>{PARA}<div class='share-price'><p>Share price: 5</div></article>") == f"{TEXT}\nShare price: 5"


def test_no_element_eats_the_page():
    for tag in ("svg", "canvas", "object", "form", "nav"):
        assert main_text(f"<article><div><{tag}></div>{PARA}</article>").endswith(TEXT)
    assert main_text(f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p>{PARA}</article>") == f"Let x=2.\n{TEXT}"
    assert main_text(f"<form action=x><input><article>{PARA}</article><p>button</form>") == TEXT
    assert main_text(f"<nav><p>menu<div class=ad>ad<article>{PARA}</article>") == TEXT
    assert main_text(f"<article>{PARA}<svg><title>t</title><text>drawn</text></svg><p>b</article>") == f"{TEXT}\nb"


def test_pages_without_an_article():
    menu = "<div>" + "".join(f"<a href=/{i}>Menu {i}</a><br>" for i in range(5)) + "</div>"
    blog = f"<body>{menu}<div id=wrap><div class=post><h1>Title</h1><p>By A. Writer<p>1 May<p>Intro.{PARA}<p>Aside.{PARA}<p>End.</div>{menu}</div><div class=footer>{PARA}</div></body>"
    assert main_text(blog) == f"Title\nBy A. Writer\n1 May\nIntro.\n{TEXT}\nAside.\n{TEXT}\nEnd."
    table = f"<table><tr><td>{menu}</td><td><h1>Title</h1>{PARA}<p>End.</td></tr></table>"
    assert main_text(table) == f"Title\n{TEXT}\nEnd."
    plain = f"<body>{TEXT}<br>And more.<br>{TEXT}{menu}</body>"
    assert main_text(plain) == f"{TEXT}\nAnd more.\n{TEXT}"
    assert main_text(f"<body>{menu}</body>") == "\n".join(f"Menu {i}" for i in range(5))
