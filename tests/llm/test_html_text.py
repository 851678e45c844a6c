import pytest

from strata.llm.html_text import common_lines, extract_pages, main_text, page_blocks

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li>Home</li></ul></nav><div class='ad'>Buy</div><article><h1>Head &amp;\n line</h1>"
    "<p><b>One &lt;tag&gt;<br>two<p>Three<form><input>x</form><div class='comments'><p>me too</p></div></article>"
    "<aside>Side</aside><footer>&copy; me</footer></body></html>"
)


def test_article_of_a_page():
    assert main_text(PAGE, None) == "Head & line\n\nOne <tag> two\n\nThree"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("<p>cut <b", "cut"),
        ("<p>cut &am", "cut &am"), ("<p>cut &amp", "cut &"), ("<p>cut</p", "cut"), ("<p>x</p><", "x"),
        ("<p>a <!-- <p>no --> b", "a b"), ("<p title='>'>a", "a"), ('<p title="open>a</p>', ""),
        ("<script>never closed <p>a", ""), ("<article><p>a</p><nav>n</nav>b</article><p>c</p>", "a\n\nb"),
        ("<div class='no-sidebar'><p>a</p></div>", "a"), ("<div class='site-header'>a</div>b", "b"),
        ("<p>&#233;&#x4e2d;&nbsp;&eacute;</p>", "é中 é"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ("<p>1 < 2 and a<b</p>", "1 < 2 and a"), ("</p></div>x", "x"), ("<P>A</P><BR/>B", "A\n\nB"),
        ("<main><article><p>a</p></article></main>", "a"), ("<p style='display:none'>a</p>b", "b"),
    ],
)
def test_details(page, text):
    assert main_text(page, None) == text


@pytest.mark.parametrize(
    "one, other",
    [([], []), ([1], []), ([1, 2, 3], [1, 2, 3]), ([1, 2, 3, 4], [2, 4]), ([1, 1, 2, 1], [1, 2, 2, 1, 1]),
     ([5, 1, 2, 3, 9, 4], [1, 7, 2, 9, 3, 4]), ([3, 2, 1], [1, 2, 3])],
)
def test_common_lines(one, other):
    table = [[0] * (len(other) + 1) for _ in range(len(one) + 1)]
    for i, a in enumerate(one):
        for j, b in enumerate(other):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    found = common_lines(one, other)
    assert found == sorted(set(found)) and len(found) == table[-1][-1]
    rest = iter(other)
    assert all(one[i] in rest for i in found)


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "t", 1, "k", "h") for r in rows],
        "page_id bigint, url string, html string, text string, n_chars int, page string, beside string",
    )


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_lines_that_neighbours_share_go(spark):
    def site(*lines):
        return "".join(f"<p>{x}</p>" for x in ("Our site", "Links", *lines, "Imprint"))

    found = extract_pages(
        pages(
            spark,
            [
                (1, "http://a.example/1", site("first story", "more")), (2, "http://a.example/2?x=1", site("second story")),
                (3, "https://A.example/3#top", site("third story", "Links")), (4, "http://b.example/1", site("only page")),
                (5, "http://a.example/2", site("second story")), (6, "http://c.example/1", site("copy")),
                (7, "http://c.example/2", site("copy")), (8, None, site("no address")),
            ],
        )
    )
    assert found.columns == ["page_id", "url", "page", "beside", "text", "n_chars"]
    assert texts(found) == {
        1: "first story\n\nmore", 2: "second story", 3: "third story\n\nLinks", 5: "second story",
        4: "Our site\n\nLinks\n\nonly page\n\nImprint", 6: "Our site\n\nLinks\n\ncopy\n\nImprint",
        7: "Our site\n\nLinks\n\ncopy\n\nImprint", 8: "Our site\n\nLinks\n\nno address\n\nImprint",
    }


def test_the_neighbour_has_the_longer_path_in_common(spark):
    def page(section, own):
        return f"<p>Our site</p><p>{section} links</p><p>{own}</p>"

    rows = [
        (1, "http://a.example/news/1", page("News", "one")), (2, "http://a.example/news/2", page("News", "two")),
        (3, "http://a.example/shop/x/1", page("Shop", "three")), (4, "http://a.example/shop/x/2", page("Shop", "four")),
        (5, "http://a.example/top", page("Top", "five")),
    ]
    # The first of the shop is aligned with the second, not with the news before it.
    assert texts(extract_pages(pages(spark, rows))) == {1: "one", 2: "two", 3: "three", 4: "four", 5: "Top links\n\nfive"}


def test_articles_keep_what_they_share(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.replace("Three", f"Three {i % 2}")) for i in range(4)]
    assert texts(extract_pages(pages(spark, rows)))[2] == "Head & line\n\nOne <tag> two\n\nThree 0"


def test_awkward_rows(spark):
    rows = [
        (None, None, None), (1, None, ""), (2, "", "<p>a"), (2, "", "<p>a"), (3, "not a url", "<p>" + "x " * 200_000),
        (4, "http://a.example", "<p>" * 5000 + "deep"), (5, "http://a.example/é", "<p>\U0001f600\x00"),
    ]
    found = extract_pages(pages(spark, rows))
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found.select("page_id", "text", "n_chars").collect()) == sorted(
        [(0, "", 0), (1, "", 0), (2, "a", 1), (2, "a", 1), (3, ("x " * 200_000).strip(), 399_999), (4, "deep", 4),
         (5, "\U0001f600\x00", 2)]
    )
    assert extract_pages(pages(spark, [])).collect() == []


def test_blocks_say_where_they_stand():
    assert [b for b in page_blocks(PAGE) if b[1] and not b[2]] == [
        ("Head & line", True, False), ("One <tag> two", True, False), ("Three", True, False),
    ]


def test_text_outside_the_article_goes_only_where_it_is_shared(spark):
    def page(i, story):
        return (
            f"<nav>Home</nav><p>Our site</p><h1>Head {i}</h1><p>Lead {i}</p>{story}"
            f"<article><p>Body {i}</p></article><p>Imprint</p><footer>Foot</footer>"
        )

    rows = [(i, f"http://a.example/{i}", page(i, f"<div>Story {i}</div>")) for i in range(3)]
    rows += [(9, "http://b.example/1", page(9, ""))]
    found = texts(extract_pages(pages(spark, rows)))
    assert found == {
        **{i: f"Head {i}\n\nLead {i}\n\nStory {i}\n\nBody {i}" for i in range(3)},
        9: "Our site\n\nHead 9\n\nLead 9\n\nBody 9\n\nImprint",
    }
