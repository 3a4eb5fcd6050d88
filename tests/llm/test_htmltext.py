import pytest

from logtally.llm import htmltext
from tests.llm.helpers import by_id

LONG = "the river and the stone are of the same old grey as it was in the days when they were with us all year"
CASES = [
    (None, ""), ("", ""), ("   \n", ""), ("<html><body></body></html>", ""),
    ("plain words of the page", "plain words of the page"),
    # menus, adverts, footers, scripts around an article whose short blocks stay
    ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
     "<nav><ul><li><a href='/a'>A</a></li></ul></nav><!-- ad 0 --><div class='ad'>Buy now the thing and that.</div>"
     "<article><h1>Head&amp;</h1><p><b>Short.<br><p>One  two\n three&nbsp;four</p><p>Er.</p></article>"
     "<footer>&copy; x</footer></body></html>", "Head&\n\nShort.\n\nOne two three four\n\nEr."),
    # sidebar, notice, form and comments inside the article element
    ("<article><p>Text one.</p><aside><p>" + LONG + "</p></aside><div class='cookie-notice'>We use cookies</div>"
     "<form><label>Name</label><input></form><p>Text two.</p><section id='comments'><p>" + LONG + "</p></section></article>",
     "Text one.\n\nText two."),
    ("<main><div role='navigation'>a b</div><p>x</p></main>", "x"),
    ("<div class=\"sidebar\">" + LONG + "<article><p>Kept though the box before is open.</p></article>", "Kept though the box before is open."),
    # without an article element the rules decide, short blocks by their neighbours
    ("<body><div><a href=x>Home</a> <a href=y>News</a></div><h2>Title</h2><p>" + LONG + "</p><p>Short.</p><p>" + LONG + "</p>"
     "<div><a href=z>Imprint of the site and of all</a></div></body>", f"Title\n\n{LONG}\n\nShort.\n\n{LONG}"),
    # broken markup
    ("<article><p>a < b and c > d<p>e</article", "a < b and c > d\n\ne"),
    ("<article><p title=\"x>y\">in</p><p title=\"open>out</p></article>", "in\n\nout"),
    ("<article><p>one</p><!-- never closed <p>two</p>", "one"),
    ("<article><p>x</p></div></section><p>y&#233;&lt;&bogus;</p>", "x\n\nyé<&bogus;"),
    ("<article><p>a<script>if (1<2) {}</script>b</p><textarea>no</textarea></article>", "ab"),
    ("<article><P>Upper<BR/>case</P></ARTICLE>", "Upper case"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_main_text(page, want):
    assert htmltext.main_text(page) == want


def test_operator_over_a_table(spark):
    rows = [(k, f"http://x/{k}", page) for k, (page, _) in enumerate(CASES)] + [(None, None, CASES[5][0]), (0, "twice", None)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit(1)).withColumn("text", F.lit("x"))
    out = htmltext.extract_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = by_id(out.where("url is not null and url <> 'twice'"), "page_id")
    assert [got[k]["text"] for k in range(len(CASES))] == [w for _, w in CASES]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert out.count() == len(rows) and htmltext.extract_text(df.limit(0)).collect() == []


def test_long_and_hostile_pages_stay_linear():
    for page in ("<div>" * 50_000 + "</p></section>" * 50_000, "<a b='>" * 50_001,
                 "<" * 200_000, "<p " * 100_000, "<a href='" * 50_000, "<div>" * 50_000 + "x", "&amp;" * 100_000, "<!--" * 50_000):
        htmltext.main_text(page)
    assert len(htmltext.main_text("<article>" + f"<p>{LONG}</p>" * 5000)) == 5000 * len(LONG) + 2 * 4999


def test_article_elements_are_a_prior_only():
    card = "<article><h3><a href=x>The other tale of the day</a></h3><p>Read on.</p></article>"
    assert htmltext.main_text(f"<nav>Menu</nav>{card}<div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>{card}{card}") == (
        f"{LONG}\n\nShort.\n\n{LONG}")
    # text on both sides of the element's edge, and an article of short blocks beside a long one
    assert htmltext.main_text(f"<div>{LONG}</div><article><p>{LONG}</p></article><footer>{LONG}</footer>") == f"{LONG}\n\n{LONG}"
    assert htmltext.main_text(f"<nav>Menu</nav><article><p>One.</p></article><nav>Menu</nav><p>{LONG}</p>") == f"One.\n\n{LONG}"
    # links inside an article go with the text around them
    assert htmltext.main_text(f"<main><h1><a href=x>Title</a></h1><p>{LONG}</p><p><a href=y>More</a></p></main>") == (
        f"Title\n\n{LONG}\n\nMore")


POLISH = "Rzeka płynie powoli przez starą dolinę, gdzie ludzie od wieków uprawiają ziemię i łowią ryby o świcie"
RUSSIAN = "Река медленно течёт через старую долину, где люди веками возделывают землю и ловят рыбу на рассвете"
CHINESE = "河水缓缓流过古老的山谷，" * 8


@pytest.mark.parametrize("text", [POLISH, RUSSIAN, CHINESE, POLISH + " " + POLISH, "x = f(y); " * 20 + "z", "Smith, Jones, Miller, " * 8 + "Wu"])
def test_long_blocks_without_known_stop_words(text):
    menu, footer = "<nav><a href=x>Menu</a></nav><div><a href=x>One link</a></div>", "<footer>Imprint</footer>"
    text = text.strip()
    assert htmltext.main_text(f"{menu}<h1>Title</h1><p>{text}</p><p>{text}</p>{footer}") == f"Title\n\n{text}\n\n{text}"
    # the same on a page that is otherwise in a known language
    page = f"<p>{LONG}</p><pre>{text}</pre><p>{LONG}</p>"
    assert htmltext.main_text(menu + page + footer) == f"{LONG}\n\n{text}\n\n{LONG}"
    linked = f"<p><a href=x>{text}</a></p>"
    assert htmltext.main_text(f"{menu}<p>{text}</p>{menu}{linked}{footer}") == text


@pytest.mark.parametrize("page,want", [
    ("<article><p>One <svg class='icon'/>two</p><iframe src='x' /><object/><canvas id=c /><p>Three</p></article>", "One two\n\nThree"),
    ("<article><svg/><p>One</p><svg><text>no</text></svg><p>Two</p></article>", "One\n\nTwo"),
    ("<article><p>One</p><div><noscript><p>no</p></div><p>Two</p></article>", "One\n\nTwo"),
    ("<article><p>One</p><object data=x>no<p>Two</p><p>Three</p></article>", "One\n\nTwo\n\nThree"),
    ("<article><p>One <canvas>no</p><p>Two</p><p>Three <noscript>no<p>Four</p></article>", "One\n\nTwo\n\nThree\n\nFour"),
    ("<head><noscript><img src=x></head><body><div><svg><path d=x>no<p>One</p></div><template>no<div>Two</div>", "One\n\nTwo"),
    ("<svg><svg><iframe>no<p>One</p>", "One"),
    ("<article><p>One</p><script/>no<p>no</p></script><p>Two</p><style>no", "One\n\nTwo"),
])
def test_elements_not_shown_that_close_themselves_or_never(page, want):
    assert htmltext.main_text(page) == want


def test_elements_that_never_close_stay_linear():
    for page in ("<svg>" * 200_000, "<div><object>" * 100_000, "<noscript>x" * 100_000 + "<p>" * 100_000):
        htmltext.main_text(page)


@pytest.mark.parametrize("n", [1, 100, 20_000, 300_000])
def test_quoted_values_of_any_length(n):
    for q, other in ("\"'", "'\""):
        value = f"{{{other}body{other}: {other}<p>no</p></article><script class={other}ad{other}>" + "x" * n + "}"
        assert htmltext.main_text(f"<article><p>One</p><div data-props={q}{value}{q}><p>Two</p></div><img src = {q}>{value}{q}>"
                                  "<p>Three</p></article>") == "One\n\nTwo\n\nThree"
        # never closed: the first ">" ends the tag; a quote that begins no value is none
        assert htmltext.main_text(f"<article><p>One</p><p title={q}{'x' * n}>Two</p></article>") == "One\n\nTwo"
        assert htmltext.main_text(f"<article><p class='a' {q} alt=it{q}s>One</p>{'x' * n}<p id=it{q}s>Two</p></article>") == (
            f"One\n\n{'x' * n}\n\nTwo")


def test_quotes_stay_linear():
    for page in ("<a b=\">\" " * 100_000, "<a b=\">\" c='" * 70_001, "<a b='>\" c=\"" * 70_001, "<a " + "'" * 300_000 + "<a b='>",
                 "<" + "a" * 300_000 + "\" ", "<div " + "a" * 300_000 + " b" * 100_000 + ">", "<div " + "a=\"b= 'c= " * 50_000 + ">",
                 "<" * 300_000 + ">", "<a b=" + " " * 300_000 + "'>"):
        htmltext.main_text(page)


PARAGRAPHS = ["The river and the stone are of the same old grey as it was in the days when they were with us all year, and the boats "
              "that came from the north were as slow as ever.",
              "In the evening the lamps are lit and the people of the town walk along the water, for it is the one hour of the day in "
              "which nothing is to be done by them."]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
MENU = '<ul class="menu"><li><a href="/a">Home</a></li><li><a href="/b">News of the day</a></li></ul>'
REMARK = '<div class="comments"><p>I think that the author is wrong, as the boats from the north were never as slow as it is said.</p></div>'
LAYOUTS = [
    f'<div class="page no-sidebar">{MENU}{BODY}</div>',
    f'<div class="header-fixed">{MENU}{BODY}{REMARK}</div>',
    f'<div class="legal-notice-page">{BODY}</div>',
    f'<body>{MENU}<article class="post has-comments">{BODY}</article>{REMARK}</body>',
    f'<form id="aspnetForm" action="/x"><div class="nav-main"><a href="/">Home</a></div>{BODY}<footer>Imprint</footer></form>',
    f'<a name="top"><div>{BODY}</div>',
    f'<body><div class="menu"><a href="/a">Home</a><a href="/b">News</a>{BODY}</body>',
    f'<div id="modal"><div class="site-header">x</div>{BODY}</div>',
    f'<div><p><a href="/top">up</p>{BODY}</div>',
]


@pytest.mark.parametrize("page", LAYOUTS)
def test_parts_around_the_article_do_not_hide_it(page):
    assert htmltext.main_text(page) == "\n\n".join(PARAGRAPHS)


@pytest.mark.parametrize("part", ['<div class="sidebar">{}</div>', '<div class="site-footer">{}</div>', '<nav>{}</nav>', "<form>{}</form>",
                                  '<div id="cookie-banner">{}</div>', '<section class="related-posts">{}</section>',
                                  '<div class="comment-list"><article class="comment">{}</article></div>'])
def test_parts_beside_the_article_go(part):
    other = part.format(f"<p>{PARAGRAPHS[1]}</p>")
    for body in (BODY, f"<article>{BODY}</article>"):
        assert htmltext.main_text(f"<body>{body}{other}</body>") == "\n\n".join(PARAGRAPHS)


def test_reader_comments_go_even_if_they_are_most_of_the_page():
    remarks = '<div class="comments">' + 20 * f"<p>{PARAGRAPHS[1]}</p>" + "</div>"
    assert htmltext.main_text(f"<body><div>{BODY}</div>{remarks}</body>") == "\n\n".join(PARAGRAPHS)


def test_both_passes_by_brute_force():
    """Random blocks: an undecided one takes the nearest decided, the two sides compared by distance."""
    import random
    rng = random.Random(3)
    for _ in range(500):
        first = rng.choices([True, False, None], k=rng.randrange(0, 12))
        want = []
        for k, own in enumerate(first):
            near = sorted((abs(j - k), not x) for j, x in enumerate(first) if x is not None)
            want.append(own if own is not None else not near[0][1] if near else True)
        assert htmltext._second_pass(first) == want
