from viewtide.llm import pages


def test_article():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
    <nav><ul><li><a href=/a>Menu</a></li></ul></nav><!-- <p>hidden</p> --><div class="ad">Buy!</div>
    <article><h1>Head &amp; line</h1><p>One&nbsp;two
    <b>three</b>.<br>four<p>Fünf &#x1F600; &lt;six&gt; &copy</p><ul><li>x<li>y</ul><aside>side</aside><form>f</form>
    <div class="user-comments"><p>First!</p></div></article>
    <div id="cookie-notice"><p>We use cookies.</p></div><footer>&copy; me</footer></body></html>"""
    assert pages.main_text(html) == "Head & line\nOne two three. four\nFünf 😀 <six> ©\nx\ny"


def test_without_marks():
    """Only the tag paths tell content from the rest."""
    prose = "A long sentence, with commas, that goes on; and on. " * 4
    links = "".join(f'<div><a href="/{i}">Link {i}</a></div>' for i in range(12))
    html = f"<html><body><div>{links}</div><div><h2>Title</h2><p>{prose}</p><p>Short one.</p><p>{prose}</p></div><div>{links}</div><span>ok</span></body></html>"
    assert pages.main_text(html) == "\n".join(["Title", prose.strip(), "Short one.", prose.strip()])


def test_teaser_article():
    """A small marked teaser does not hide a body without marks."""
    prose = "A long sentence, with commas, that goes on; and on. " * 4
    html = f"<html><body><div><h1>Title</h1><p>{prose}</p><p>{prose}</p><p>{prose}</p></div><article><p>Read this next.</p></article></body></html>"
    lines = pages.main_text(html).split("\n")
    assert lines[:4] == ["Title"] + [prose.strip()] * 3
    # Where most is marked, an unmarked line beside it is still left out.
    html = f"<html><body><span>ok</span><article><h1>Title</h1><p>{prose}</p><ul><li>x<li>y</ul><p>{prose}</p></article><div>go</div></body></html>"
    assert pages.main_text(html).split("\n") == ["Title", prose.strip(), "x", "y", prose.strip()]


def test_words_against():
    """A word in a class does not take the whole page, and headers and captions in an article stay."""
    prose = "A long sentence, with commas, that goes on; and on. " * 4
    body = f"<div><h1>Title</h1><p>{prose}</p><p>{prose}</p></div>"
    whole = "\n".join(["Title", prose.strip(), prose.strip()])
    for words in ("has-sidebar", "no-sidebar", "comments-open", "menu-closed"):
        assert pages.main_text(f'<html class="{words}"><body class="{words}">{body}</body></html>') == whole
        assert pages.main_text(f'<body><div class="{words}">{body}</div><div class="ad">Buy this, now.</div></body>') == whole
        assert pages.main_text(f'<body><article class="{words}">{body}</article></body>') == whole
    assert pages.main_text(f'<body><form id="aspnetForm"><nav><a href="/">Home</a></nav>{body}</form></body>') == whole
    assert pages.main_text(f'<body>{body}<form class="search">Find it, now.</form></body>') == whole
    assert pages.main_text(f'<body>{body}<div class="comments"><div><p>So good!</p></div></div><aside><div><p>{prose}</p></div></aside></body>') == whole
    assert pages.main_text(f"<body>{body}<div hidden><section><p>{prose}</p></section></div></body>") == whole
    html = '<body><div class="ad">An advert, longer than the page is. Buy it, now.</div><article><h1>Small.</h1><p>Small.</p></article>'
    assert pages.main_text(f"{html}<footer>Written by somebody who lives in a town far from here.</footer></body>") == "Small.\nSmall."
    html = f"<body><header><p>Site name.</p></header><article><header><h1>Title</h1></header><p>{prose}</p><figure><figcaption>A river, in May.</figcaption></figure></article></body>"
    assert pages.main_text(html) == "\n".join(["Title", prose.strip(), "A river, in May."])


def test_odd_pages():
    for html in (None, "", "   ", "<p", "<!-- open", "<script>x", "<nav>only</nav>"):
        assert pages.main_text(html) == ""
    assert pages.main_text("<") == "<"  # no tag begins here
    assert pages.main_text("plain &lt; text") == "plain < text"
    assert pages.main_text("<p>a < b and c > d</p>") == "a < b and c > d"
    assert pages.main_text('<article><p title="a>b">in</p><p class=">x</p><p>y</p></article>') in ("in\nx\ny", "in\ny", "in")
    assert pages.main_text("<article>" + "<p>x" * 20000 + "</article>").count("x") == 20000


def test_linear():
    """Unclosed quotes and tags do not make a page slow."""
    pages.main_text('<a title="' * 20000)
    pages.main_text("<div><p>" * 3000 + "x")
    pages.main_text("<!--" * 50000)


def test_rows(session):
    rows = [(1, "u", "<main><p>é</p></main>", "t"), (1, "u", "<main><p>é</p></main>", "t"), (2, None, None, None), (None, "v", "", "")]
    df = session.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in pages.main_texts(df).collect())
    assert found == [(0, "v", "", 0), (1, "u", "é", 1), (1, "u", "é", 1), (2, "", "", 0)]
    assert pages.main_texts(df.limit(0)).collect() == []


def test_boilerplate_that_outweighs_the_body():
    """However long comments, notices, adverts and forms are, the body alone is returned."""
    prose = "A long sentence, with commas, that goes on; and on. "
    own = f"<p>{prose}</p><p>{prose * 2}</p>"
    whole = "\n".join([prose.strip(), (prose * 2).strip()])
    for count in (3, 40, 400):
        long = "".join(f"<div><p>{prose * 3}</p></div>" for _ in range(count))
        for extra in (
            f'<div class="comments">{long}</div>',
            f'<section id="comments"><article><header>A reader</header>{long}</article><nav><a href="/2">Older</a></nav></section>',
            f'<div class="cookie-notice">{long}</div>',
            f'<div class="ad">{long}</div>',
            f"<form>{long}</form>",
        ):
            for page in (f"<article>{own}</article>{extra}", f"<article>{own}{extra}</article>", f"<div>{own}</div>{extra}", f"{extra}<main>{own}</main>"):
                assert pages.main_text(f"<body>{page}</body>") == whole, page[:200]
            assert pages.main_text(f"<body>{extra}</body>") == ""


def test_linked_paragraphs():
    """Links lower a path's score; they take no paragraph out of an article, and lists of links go."""
    prose = "A long sentence, with commas, that goes on; and on. "
    menu = "".join(f'<li><a href="/{i}">Place number {i}</a></li>' for i in range(15))
    html = f'<body><ul>{menu}</ul><article><h1>Title</h1><p>{prose}</p><p><a href="/">{prose}</a></p><ul><li><a href="/x">one</a></li><li>two</li></ul></article><div><ul>{menu}</ul></div></body>'
    assert pages.main_text(html) == "\n".join(["Title", prose.strip(), prose.strip(), "one", "two"])
