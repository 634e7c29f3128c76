from sensorloom.llm.html import extract, main_text, parse, templates

HEAD = '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T {i}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
NAV = '<nav><ul><li><a href="/a">menu {i}</a></li></ul></nav><!-- ad {i} --><div class="ad">buy {i}</div><header><p>site</p></header>'
FOOT = '<aside>side {i}</aside><form>mail {i}</form><div id="cookie-notice">we use cookies</div><footer>&copy; host {i}</footer></body></html>'
BODY = "<h1>T&amp;{i}</h1><p><b>One  {i}&nbsp;a\n b<br><p>Two &lt;{i}&gt; <i>x</i>y</p><ul><li>l1<li>l2</ul><section class='comments'><p>me too</p></section>"
WANT = "T&{i}\nOne {i} a b\nTwo <{i}> xy\nl1\nl2"


def page(i, body=BODY):
    return (HEAD + NAV + "<article>" + body + "</article>" + FOOT).format(i=i)


def test_article(spark):
    rows = [(i, f"http://h.example/{i}", page(i), 5) for i in range(6)] + [(10, "http://alone.example/", page(9), 5)]
    rows += [(11, None, None, 1), (12, "http://h.example/x", "", 1), (None, "u", "<p>plain <b>text", 1), (0, "http://h.example/0", page(0), 5),
             (13, "http://h.example/cut", page(7)[:-30], 1)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")).collect()
    assert len(got) == len(rows)
    want = {i: WANT.format(i=i) for i in range(6)} | {10: WANT.format(i=9), 11: "", 12: "", None: "plain text", 13: WANT.format(i=7)}
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_template_without_article(spark):
    html = "<html><body><div class=top>Welcome to our site</div><div class=x><p>story {i}</p><p>more of {i}</p></div><div class=low>All rights, always</div></body></html>"
    rows = [(i, f"https://user@News.example:80/{i}", html.format(i=i)) for i in range(5)] + [(9, "https://other.example/", html.format(i=9))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(frame).collect()}
    assert got[3] == "story 3\nmore of 3"
    assert got[9] == "Welcome to our site\nstory 9\nmore of 9\nAll rights, always"
    found = templates(frame).collect()
    assert {r.host for r in found} == {"news.example:80"}
    inner = {r.token: (r["class"], r.parent) for r in found}
    assert inner["/html/body/div.x"][1] == inner["/html/body"][0]
    assert "/html/body/div.x/p" not in inner  # twice a page, and alone in its class


def plain_fixed(pages, least=5):
    """Texts of articles that stand on every different page of the host as often as its body does, by explicit vectors."""
    contents = sorted(set(pages))
    parsed = [parse(p) for p in contents]
    vectors = {}
    for k, p in enumerate(parsed):
        for path, aside, main, text in p.blocks:
            if main and not aside:
                vectors.setdefault((path, text), [0] * len(contents))[k] += 1
    frame = [p.paths["/html/body"] for p in parsed]
    return {text for (_, text), v in vectors.items() if v == frame and all(v)} if len(contents) >= least else set()


def test_fixed_text_inside_articles(spark):
    body = "<html><body><nav>m</nav><article><h1>T {i}</h1><p>story {i}</p><h2>Conclusion</h2><p>end {e}</p><div><p>Thanks for reading {h}!</p></div></article></body></html>"
    rows = []
    for h, n in (("big", 9), ("small", 3)):
        for i in range(n):
            html = body.format(i=i, e=i % 2, h=h)
            if i == 1:
                html = html.replace("<h2>Conclusion</h2>", "<h2>Outlook</h2>")
            rows += [(f"{h}{i}", f"http://{h}.example/{i}", html)] * (1 + i % 2)
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    for h in ("big", "small"):
        fixed = plain_fixed([html for k, _, html in rows if k.startswith(h)])
        assert fixed == ({"Thanks for reading big!"} if h == "big" else set())
        for k, _, html in rows:
            if k.startswith(h):
                assert got[k] == "\n".join(t for _, aside, main, t in parse(html).blocks if main and not aside and t not in fixed)


def test_long_page():
    text = "<article>" + "<p>word &amp; word</p>" * 50_000 + "<div>" * 3000 + "deep" + "</div>" * 3000
    assert main_text(parse(text), set()).count("\n") == 50_000


def test_wrappers_of_an_article():
    own = "<article><p>own</p></article>"
    for wrapper in ("form id=aspnetForm", "div class='content sidebar-right'", "div class='no-sidebar'", "div id='social-page'", "div class='no-comments'"):
        for main in ("", "<main>"):
            html = f"<body>{main}<{wrapper}><nav>menu</nav>{own}<p>low</p></{wrapper.split()[0]}></body>"
            assert main_text(parse(html), set()) == "own", html
    for box in ("section class=comments", "aside", "div id=sidebar", "div class='related-posts'"):
        html = f"<body>{own}<{box}><article><p>of others</p></article></{box.split()[0]}></body>"
        assert main_text(parse(html), set()) == "own", html
    assert main_text(parse("<article><p>own<div class='related-posts'><article>teaser</article></div></article>"), set()) == "own"


def test_names_inside_an_article():
    kept = ["<h2 id='related-work'>a</h2>", "<p class='side-effects'>a</p>", "<section id='social-history'><p>a</p></section>", "<h2 id='menu'>a</h2>",
            "<p class='notice'>a</p>", "<div class='post-header'><h1>a</h1></div>", "<li class='share'>a</li>"]
    for html in kept:
        assert main_text(parse(f"<body><nav>x</nav><article><p>b</p>{html}</article></body>"), set()) == "b\na", html
    for html in ("<div class='ad'>x</div>", "<div id='comments'>x</div>", "<ul class='share'><li>x</ul>", "<aside>x</aside>", "<section class='big notice'>x</section>"):
        assert main_text(parse(f"<body><article><p>b</p>{html}</article></body>"), set()) == "b", html


def test_inline_asides_do_not_end_a_block():
    for inner in ("<span class=ad>buy</span>", "<script>var x</script>", "<button>press</button>", "<select><option>1</select>"):
        assert main_text(parse(f"<article><p>Hello {inner} world</p></article>"), set()) == "Hello world", inner


def test_story_beside_teasers():
    html = "<body><section class=teasers><article><p>teaser</p></article></section><div><p>the story itself</p></div></body>"
    assert main_text(parse(html), set()) == "the story itself"


def test_copies_are_one_page(spark):
    html = "<html><body><div class=top>Welcome to our site</div><p>story {i}</p><p>more of {i}</p></body></html>"
    rows = [(i, f"http://twice.example/{i}", html.format(i=1)) for i in range(2)]
    rows += [(10 + i, f"http://half.example/{i}", html.format(i=max(0, i - 3))) for i in range(8)]  # four copies of page 0
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == got[1] == "Welcome to our site\nstory 1\nmore of 1"
    assert all(got[10 + i] == "story {0}\nmore of {0}".format(max(0, i - 3)) for i in range(8))


def test_columns_of_any_name(spark):
    rows = [(1, "http://a.example/", "<article><p>own</p></article>", "h", "t", "c")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, _host string, _template string, class string")).first()
    assert (got._host, got._template, got["class"], got.text) == ("h", "t", "c", "own")
