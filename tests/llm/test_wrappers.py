from __future__ import annotations

from parcella.llm import wrappers


def read(spark, pages):
    frame = spark.createDataFrame(
        [(i, u, h, "t", "x") for i, (u, h) in enumerate(pages)],
        "page_id long, url string, html string, text string, host string",
    )
    return {r.page_id: r.text for r in wrappers.extract(frame).collect()}


def page(body, extra="", title="T"):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head>"
        f"<body><header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><!-- ad -->"
        f"<div class=\"ad-box\">Buy {title}</div>{body}<div id='cookie-notice'>We use cookies</div>"
        f"<aside>More</aside><div class='comments'><p>Nice {title}!</p></div>{extra}"
        "<form>Mail <input name=a></form><footer>&copy; Site</footer></body></html>"
    )


def test_article_without_furniture(spark):
    got = read(spark, [
        ("http://a.com/1", page("<article><h1>One &amp; only</h1><p>First <b>bold</b>  text.<br><p>Second&nbsp;par\n<em>x</em>y</article>", title="1")),
        ("http://a.com/2", page("<article><h1>Two</h1><p>Other<p>Open <div class='share widget'>Share</div></article>", title="2")),
        ("http://a.com/3", page("<article><h1>Three</h1></article>", title="3")),
    ])
    assert got == {0: "One & only First bold text. Second par xy", 1: "Two Other Open", 2: "Three"}


def test_slots_without_article_elements(spark):
    body = "<div class='wrap'><div class='intro'>Welcome to the same old site</div><div class='body'><p>{}</p><p>{}</p></div></div>"
    pages = [(f"http://b.com/{i}", page(body.format(f"alpha {i} " * 9, f"beta {i}"), title=str(i))) for i in range(6)]
    got = read(spark, pages)
    assert got == {i: f"alpha {i} " * 9 + f"beta {i}" for i in range(6)}


def test_template_widget_inside_the_article_goes_and_prose_stays(spark):
    pages = [
        (f"http://c.com/{i}", page(f"<article><div class='byline x'>By the desk</div><p>Same opening line.</p><p>Text {i}</p></article>"))
        for i in range(4)
    ]
    assert read(spark, pages) == {i: f"Same opening line. Text {i}" for i in range(4)}


def test_equal_pages_of_a_host_keep_their_article(spark):
    pages = [("http://d.com/x", page("<article><p>All the same</p></article>"))] * 5
    assert read(spark, pages) == {i: "All the same" for i in range(5)}


def test_edges(spark):
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    got = read(spark, [
        (None, None), ("no url", ""), ("http://e.com/", "plain & text"), ("http://e.com/2", "<p>open <b>never closed"),
        ("http://e.com/3", "</p></div>stray<br/>line < 3"), ("http://e.com/4", deep), ("http://e.com/5", "<article>" + "<p>w</p>" * 30_000),
        (None, "<main>m</main><footer>f</footer>"), ("http://f.com", "<script>never ends"), ("http://f.com/2", "<a title='x>text"),
        ("http://g.com", "<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>"),
    ])
    assert got[0] == "" and got[1] == "" and got[2] == "plain & text" and got[3] == "open never closed"
    assert got[4] == "stray line < 3" and got[5] == "deep" and got[6] == " ".join("w" * 30_000)
    assert got[7] == "m" and got[8] == "" and got[9].endswith("text") and got[10] == "one two a b"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert wrappers.extract(empty).count() == 0


def test_simple_tree_matching_is_the_largest_ordered_match():
    def tree(spec):
        return wrappers.Skeleton.of(wrappers.parse(spec))

    a = tree("<div class=a></div><p>x</p><section><ul></ul></section>")
    b = tree("<p>x</p><div class=n></div><section><h2>t</h2><ul></ul></section><div class=a></div>")
    score, pairs = wrappers.align(a, b)
    assert score == len(pairs) == 4  # page, p, section, ul
    assert {(a.labels[i], b.labels[j]) for i, j in pairs} == {(x, x) for x in ("#page", "p", "section", "ul")}


def test_a_widget_goes_only_where_it_has_the_template_text(spark):
    body = "<article><div class='update'>{}</div><p>Text {} of its own</p></article>"
    pages = [(f"http://h.com/{i:02}", page(body.format("No update" if i != 7 else "Ten people were found", i))) for i in range(20)]
    got = read(spark, pages)
    assert got == {i: "Ten people were found " * (i == 7) + f"Text {i} of its own" for i in range(20)}


def test_copies_and_edited_copies_do_not_turn_content_into_template(spark):
    body = "<article><section class='part'>{} long section that stays as it is</section><p>{}</p></article>"
    copies = [(f"http://i.com/{i}", page(body.format("One", "first"))) for i in range(30)]
    others = [(f"http://i.com/x{i}", page(body.format(f"Other {i}", f"other {i}"))) for i in range(3)]
    edited = [(f"http://j.com/{i}", page(body.format("Edited", f"edit {i}"))) for i in range(9)]
    got = read(spark, copies + others + edited)
    assert all(got[i] == "One long section that stays as it is first" for i in range(30))
    assert [got[i] for i in range(30, 33)] == [f"Other {i} long section that stays as it is other {i}" for i in range(3)]
    assert [got[i] for i in range(33, 42)] == [f"Edited long section that stays as it is edit {i}" for i in range(9)]


def test_headline_and_short_block_stay_with_the_long_text(spark):
    body = "<div class='wrap'><h1>Title {0}</h1><div class='text'><p>" + "word {0} " * 80 + "</p></div><div class='extra'>More {0}</div></div>"
    got = read(spark, [(f"http://k.com/{i}", page(body.format(i))) for i in range(5)])
    assert got == {i: f"Title {i} " + f"word {i} " * 80 + f"More {i}" for i in range(5)}


def test_articles_that_the_reference_lacks_are_read(spark):
    one, two = "<article class='a'><p>First {0}</p></article>", "<div class='ad'>Buy</div><article class='b'><p>Second {0}</p></article>"
    pages = [("http://l.com/0", "")] + [(f"http://l.com/{i}", page(one.format(i))) for i in range(1, 6)]
    pages.append(("http://l.com/6", page((one + two).format(6))))
    got = read(spark, pages)
    assert got[0] == "" and got[6] == "First 6 Second 6" and all(got[i] == f"First {i}" for i in range(1, 6))


def test_readers_comments_are_articles_too(spark):
    body = (
        "<article><p>text {0}</p><article><p>reader {0} says</p></article>"
        "<section><article class='comment'><p>so does {0}</p></article></section><p>end</p></article>"
        "<article class='comment-reply'><p>and {0}</p></article>"
    )
    got = read(spark, [(f"http://c.com/{i}", page(body.format(f"w{i}"))) for i in range(5)])
    assert got == {i: f"text w{i} end" for i in range(5)}
    alone = read(spark, [
        ("http://d.com/", "<article><p>a</p><article class=comment><p>reader says</p></article></article>"),
        ("http://e.com/", "<article class=page><article><p>a</p></article> <article><p>b</p></article></article>"),
        ("http://f.com/", "<main><article><p>a</p></article><article><p>b</p></article></main>"),
    ])
    assert alone == {0: "a", 1: "a b", 2: "a b"}
