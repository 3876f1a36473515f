"""Main text of pages with all kinds of boilerplate, and the host vote."""
import html as h
import re

from txwatch.llm import html_extract as H

SCHEMA = "page_id long, url string, html string, text string, host int"
PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="home"><header class="site-header"><h1>Site</h1><nav><ul><li><a href="/">Home</a><li><a>About us all</a></ul></nav></header>
<div id="cookie-notice">We use cookies to follow you around everywhere you go.</div><!-- <p>hidden</p> -->
<div class="layout"><div class="post-%d content" data-x="a>b"><article class="post comments-open"><header><h2>Title &lt;x&gt;</h2><p>by me</p></header>
<p>First&nbsp; para <b>bold<i>er</b> text</i>,
 more<br>lines &eacute;&#233;.<p>Second para with a <a href="#">link</a> inside it.
<ul><li>one item<li>two items</ul><blockquote>Quoted <p>deep</p> tail</blockquote><div class="ad-slot">Buy now! Buy now! Buy now!</div>
<table><tr><td>c1<td>c2<tr><td>c3</table><form><p>Your mail</p><input></form><pre>a  b
c</pre></article><section class="comments"><p>%s</p></section></div>
<aside><p>Sidebar text sidebar text sidebar text.</p></aside></div><footer>&copy; me</footer></body></html>"""
WANT = ["Title <x>", "First para bolder text, more lines éé.", "Second para with a link inside it.", "one item", "two items",
        "Quoted", "deep", "tail", "c1", "c2", "c3", "a b c"]


def test_boilerplate_goes_and_blocks_stay():
    page = PAGE % (7, "I am a very long reader comment. " * 40)
    assert H.extract(page, []) .split("\n\n") == WANT
    assert H.vote(page) == "html/body.home/div.layout/div.content.post-#/article.comments-open.post"


def test_host_vote_wins_over_a_page_of_its_own(spark):
    usual = "<body><div class='a1'><p>" + "main text here " * 20 + "</p></div><div class='b'><p>short</p></div></body>"
    odd = "<body><div class='a2'><p>main</p></div><div class='b'><p>" + "more of it " * 30 + "</p></div></body>"
    rows = [(i, "https://u:p@Host.example.com:80/x", usual) for i in range(8)] + [(8, "http://host.example.com", odd)]
    rows += [(9, "http://other.example.org/", odd), (10, None, odd), (11, "no url", usual), (12, "http://host.example.com", None),
             (13, "http://host.example.com", ""), (14, "http://x.y", "plain text &amp; <b>no tags</b>"), (15, "http://x.y", "<p"),
             (16, "http://x.y", "<div>" * 3000 + "deep" + "<p>x " * 2000), (9, "http://other.example.org/", odd)]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA).repartition(3)
    got = {r.page_id: r for r in H.main_text(df).collect()}
    assert H.main_text(df).count() == len(rows)
    assert got[8].text == "main" and got[9].text.startswith("more of it") and got[10].text == got[9].text
    assert got[0].text == got[11].text == ("main text here " * 20).strip()
    assert got[12].text == got[13].text == got[15].text == "" and got[14].text == "plain text & no tags"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert got[0].url == rows[0][1] and got[10].url is None
    assert H.main_text(df.limit(0)).count() == 0


def test_whole_table_matches_its_articles(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in df.collect()}
    rows = H.main_text(df).collect()
    assert len(rows) == len(source)
    for r in rows:
        a = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1], flags=re.S)
        parts = [" ".join(h.unescape(re.sub(r"<[^>]*>", "", s.replace("<br>", " "))).split()) for s in re.split(r"</?(?:p|h1)\b[^>]*>", a)]
        assert r.text == "\n\n".join(p for p in parts if p)


def test_elements_inside_a_line_swallow_no_text():
    for odd in ('<svg class="i"/>', "<math/>", "<svg><path d='M0'>", "<p>x <button>b</p>", "<div><object>o</div>", "<div><audio>o</div>",
                "<div><video src=a>o</div>", "<div><select><option>o</div>", "<div><canvas></div>"):
        page = f"<article><p>first</p>{odd}<p>second</p></article>"
        assert [t for t in H.extract(page, []).split("\n\n") if t != "x"] == ["first", "second"], odd
    page = ("<article><p>a <svg><title>t</title><text>no</text></svg>b <button><div>no<p>no</div></button>c</p>"
            "<p>d <select><option>no</select>e <svg><foreignObject><p>no</p></foreignObject></svg>f</p><template><p>no</p></template></article>")
    assert " ".join(H.extract(page, []).split()) == "a b c d e f"


def test_layout_wrappers_with_bad_words_keep_their_article():
    inner = "<article><p>" + "main text here " * 9 + "</p></article>"
    for wrap in ('<div class="layout with-sidebar">', '<div id="has-comments">', '<div class="page header-fixed">', '<section class="article-share">'):
        tag = wrap[1:].split()[0]
        side = '<div class="left-sidebar"><p>side</p></div><section class="related-posts"><p>other</p></section>'
        assert H.extract(f"<body>{wrap}{inner}{side}</{tag}></body>", []) == ("main text here " * 9).strip(), wrap
        plain = f"<body>{wrap}<div class=x><p>{'main text here ' * 9}</p></div></{tag}><div><a href=/>{'link ' * 99}</a></div></body>"
        assert H.extract(plain, []) == ("main text here " * 9).strip(), wrap
        assert H.extract(f"<div id=site-header><h1>Site</h1></div>{plain}", []) == ("main text here " * 9).strip(), wrap
    cards = '<div class="related-posts"><article><p>' + "a card " * 99 + "</p></article></div>"
    assert "card" not in H.extract(f"<body>{inner}{cards}</body>", [])
    assert "card" not in H.extract(f"<body><h1>Title</h1>{inner}{cards}</body>", [])
    both = '<div class="post-share"><article><p>one</p></article></div>' * 2
    assert H.extract(f"<body>{both}</body>", []).count("one") == 2


def test_text_around_the_largest_container_stays():
    lead, body, rest = "lead " * 20, "body text " * 100, "rest " * 60
    for tag in ("main", "article", "div class=post"):
        end = tag.split()[0]
        page = (f"<body><div class=top><p>{'x ' * 30}</p></div><{tag}><h1>T</h1><p>{lead}</p><div class=body><p>{body}</p></div></{end}>"
                f"<div class=more><p>other</p></div></body>")
        assert H.extract(page, []).split("\n\n") == ["T", lead.strip(), body.strip()], tag
        assert H.extract(page, [H.vote(page)]) == H.extract(page, [H.vote(page).rsplit("/", 1)[0] + "/none"]) == H.extract(page, [])
        inner = H.vote(page) + "/div.body"
        assert H.extract(page, [inner]) == H.extract(page, [])
    for tag in ("article", "main", "div class=post"):
        page = (f"<body><{tag}><section class=intro><div class=text><p>{rest}</p></div></section><section class=rest><div class=content>"
                f"<p>{body}</p></div></section></{tag.split()[0]}></body>")
        assert H.extract(page, []).split("\n\n") == [rest.strip(), body.strip()], tag
    links = f"<main><div class=body><p>{body}</p></div><div class=tags><a href=/>{'tag ' * 50}</a></div></main>"
    assert H.extract(links, []) == body.strip()
    cards = f"<main><h1>T</h1><article><div class=x><p>{body}</p></div></article><article><p>{rest}</p></article></main>"
    assert H.extract(cards, []) == body.strip()


def test_forms_and_whole_words_around_the_content_keep_it():
    body = "<p>" + "main text here " * 9 + "</p>"
    want = ("main text here " * 9).strip()
    for wrap in ("<form id=aspnetForm>", '<div class="elementor-widget-container widget">', "<fieldset>", '<div class="comment form">'):
        tag = wrap[1:-1].split()[0]
        for inner in (f"<article>{body}</article>", f"<main>{body}</main>", f"<h1>T</h1><div>{body}</div>", body):
            assert want in H.extract(f"<body><nav><a href=/>menu</a></nav>{wrap}{inner}</{tag}><footer><p>foot</p></footer></body>", []), (wrap, inner)
    page = f"<body><article>{body}</article><div class=comments><article><p>{'a comment ' * 90}</p></article></div><form><p>mail me</p></form></body>"
    assert H.extract(page, []) == want
    assert H.extract(f"<body><article>{body}<div class='reader-responses'><p>I think so too</p></div></article></body>", []) == want
    assert H.extract("<body><div class=comments><p>one</p></div><form><p>two</p></form></body>", []) == "one\n\ntwo"
    assert H.extract("<body><nav><p>menu</p></nav></body>", []) == ""


def test_a_lead_in_the_header_of_an_article_stays():
    lead = "This is the lead of the article and it has quite a few words."
    page = f"<article><header><h1>T</h1><p>by me</p><p>{lead}</p></header><p>{'text ' * 40}</p></article>"
    assert H.extract(page, []).split("\n\n") == ["T", lead, ("text " * 40).strip()]


def test_deep_pages_take_little_memory():
    import tracemalloc
    page = "<div class='a b/c'>" * 50_000 + "<p>deep text</p>"
    tracemalloc.start()
    assert H.extract(page, []) == "deep text"
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
    path = H.vote(page)
    assert path.count("/") >= 50_000 - 1 and H.extract(page, [path]) == "deep text"
