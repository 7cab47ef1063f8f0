import random

from tidemark.llm import html


def text_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, _row string")
    out = html.main_text(pages)
    assert out.columns == ["page_id", "url", "_row", "text"]
    return {r["page_id"]: r["text"] for r in out.collect()}


def test_marked_article_alone_is_kept(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a>Home</a></nav><header>Site</header>"
            "<div class='cookie-banner'>We use cookies</div><article><h1>Head &amp; line</h1><p>One  two\n three<br>four</p>"
            "<script>var x = '<p>no</p>';</script><div class=\"ad\">Buy</div><form><p>f</p></form><p>caf&eacute; &#x41;</p></article>"
            "<div id=comments><p>first!</p></div><aside>side</aside><footer>foot</footer></body></html>")
    got = text_of(spark, [(1, "http://a.b/x", page, "r"), (2, "http://a.b/y", None, None), (3, None, "", "r"), (4, "http://[bad", "<p>only", "r"),
                          (5, "http://c.d/", "text < 3 & more <b>bold</b><!-- gone --> end", "r")])
    assert got[1] == "Head & line\nOne two three\nfour\ncafé A"
    assert got[2] == got[3] == "" and got[4] == "only" and got[5] == "text < 3 & more bold end"


def test_lines_shared_with_the_nearest_page_go(spark):
    page = lambda i: f"<div>Top line</div><p>own text {i}</p><p>more {i * 7}</p><div>Bottom line</div>"
    rows = [(i, f"http://h.org/a/{i:03d}", page(i), "r") for i in range(300)]
    rows += [(900, "http://other.org/a", page(900), "r"), (901, "http://h.org/a/000", page(0), "r")]
    got = text_of(spark, rows)
    assert got[0] == got[901]           # copies under one URL are not emptied
    for i in range(2, 300):
        assert got[i] == f"own text {i}\nmore {i * 7}", i
    assert got[900] == "Top line\nown text 900\nmore 6300\nBottom line"


def test_equal_marked_articles_both_stay(spark):
    page = "<article><p>The same story.</p></article>"
    got = text_of(spark, [(1, "http://h.org/a", page, "r"), (2, "http://h.org/b", page, "r")])
    assert got == {1: "The same story.", 2: "The same story."}


def test_marked_pages_are_told_by_their_neighbours(spark):
    page = lambda i: (f"<div>Top line</div><p>lead {i}</p><article><p>{'story ' * 9}{i}</p><p>Same line</p></article>"  # noqa: E731
                      "<div>Bottom line</div>")
    rows = [(i, f"http://h.org/a/{i:03d}", page(i), "r") for i in range(50)] + [(90, "http://alone.org/", page(90), "r")]
    got = text_of(spark, rows)
    for i in range(50):
        assert got[i] == f"lead {i}\n{'story ' * 9}{i}\nSame line", i
    assert got[90] == f"{'story ' * 9}90\nSame line"


def test_copies_are_passed_over_to_a_page_that_differs(spark):
    page = lambda t: f"<div>Top line</div><p>own {t}</p><div>Bottom line</div>"
    rows = [(i, f"http://h.org/b/{i:04d}", page("copy"), "r") for i in range(500)] + [(900, "http://h.org/c", page("last"), "r")]
    got = text_of(spark, rows)
    assert {got[i] for i in range(500)} == {"own copy"} and got[900] == "own last"


def test_zones_do_not_swallow_the_page():
    body = "<p>" + "The story goes on. " * 10 + "</p>"
    story = ("The story goes on. " * 10).strip()
    text = lambda page: [t for t, _ in html.blocks(page)]
    article = f"<article><h2 class='section-header'>Head</h2>{body}</article>"
    for open_, close in (("<div class='layout has-sidebar'>", "</div>"), ("<div id='page' class='no-comments'>", "</div>"),
                         ("<div class='with-header'>", "</div>"), ("<form id=aspnetForm>", "</form>"),
                         ("<div class='page-widget'>", "</div>")):
        page = f"<body>{open_}<nav><li>Home</nav>{article}<div class='sidebar'><p>side</div><div class=ad-slot>Buy</div>{close}</body>"
        assert text(page) == ["Head", story], open_
        assert text(f"<body>{open_}<div class='menu'>Home</div><h1>Head</h1>{body}{close}</body>") == ["Head", story], open_
    assert text("<p class='ad'>Buy<p>text</p><p>text</p>") == ["text", "text"]
    assert text(f"{body}<ul><li class=promo>Buy<li>one<li>two</ul><div><p class=ad>Buy</div>end") == [story, "one", "two", "end"]
    # Reader comments and cards stay zones, however long; a zone inside an article is one too.
    assert text(f"<article>{body}</article><div id=comments>{body * 20}</div>") == [story]
    assert text(f"{body}<div class=related><article>card</article></div>") == [story]


def test_cards_are_not_the_article(spark):
    page = f"<p>{'body text ' * 30}</p><article>related one</article><article>related two</article>"
    got = text_of(spark, [(1, "http://h.org/a", page, "r")])
    assert got[1].startswith("body text")


def test_shared_lines_are_a_longest_common_subsequence():
    r = random.Random(1)
    import numpy as np
    for _ in range(200):
        a, b = ([r.randint(0, 5) for _ in range(r.randint(0, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        got = html.shared_lines(np.array(a), np.array(b))
        assert len(got) == t[-1][-1] and got == sorted(set(got))


def test_empty_table(spark):
    assert text_of(spark, []) == {}
