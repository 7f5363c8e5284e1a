import itertools
import random
import re
from html import unescape

from barflow.llm import extract, queries


def energy(labels, costs, edges):
    return (sum(max(c, 0) for c, x in zip(costs, labels) if not x) + sum(max(-c, 0) for c, x in zip(costs, labels) if x)
            + sum(w for a, b, w in edges if labels[a] != labels[b]))


def test_minimum_cut_is_minimal():
    r = random.Random(7)
    for _ in range(300):
        n = r.randint(1, 9)
        costs = [r.choice([0, r.uniform(-3, 3)]) for _ in range(n)]
        edges = [(a, b, r.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if r.random() < .5]
        best = min(energy(x, costs, edges) for x in itertools.product([True, False], repeat=n))
        assert abs(energy(extract.minimum_cut(costs, edges), costs, edges) - best) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) x("<p>no</p>")</script></head><body>
<div class="cookie-notice"><p>We use cookies. Accept them now, please, to read the site in full.</p></div>
<header><h2>Site name</h2></header><nav><ul><li><a href=/a>Home</a><li><a href='/b'>About us</a></ul></nav>
<div id="content"><h1>A title &amp; more</h1><p>First  paragraph of the text,\n with <a href="x">a link</a> and words.
<p>Second &lt;one&gt;, caf&eacute;&nbsp;and so on until it ends here.<br>Third line, after a break, also long enough to count.</p>
<div class="ad">Buy this now. It is very cheap today and tomorrow.</div><p>Last words of the story, and then it is over.</p></div>
<div class="sidebar"><p>Most read stories of the week, as chosen by our readers.</p></div>
<form><label>Your mail</label><input name=m><button>Send</button></form>
<div class="comments"><p>I liked the story very much, thank you for it.</p><p>Me too. It was good.</p></div>
<footer><p>&copy; The site. All rights reserved.</p></footer><style>p{}</style></body></html>"""


def test_page_without_article():
    assert extract.main_text(PAGE) == "\n".join([
        "A title & more", "First paragraph of the text, with a link and words.",
        "Second <one>, café and so on until it ends here.", "Third line, after a break, also long enough to count.",
        "Last words of the story, and then it is over."])


def test_comments_go_however_deep_the_content_names():
    words = "I liked the story very much indeed and would read it again, " * 6
    page = ("<body class=main><main><div id=content><div class=post><article class=article><p>The story itself, as it was told.</p>"
            f"<p><a href=/x>A line that is a link</a></p><p>And its end.</p><div class=comments><p>{words}.</p><p>{words}.</p></div></article>")
    assert extract.main_text(page) == "The story itself, as it was told.\nA line that is a link\nAnd its end."


def test_quotes_and_references_in_odd_places():
    body = "The article goes on for some words here, and it's not over until they're all read."
    assert extract.main_text(f"<article><p title=it's>{body}</p><p>More 'words' of it.</p>") == body + "\nMore 'words' of it."
    assert extract.main_text(f'<article><p title = "a > b" data-x=\'c > "d\'>{body}</p>') == body
    assert extract.main_text("<article><p>One &am<b>p; two</b> &lt;b&gt; three.</p>") == "One &amp; two <b> three."
    many = "<article><p " + "a='\"=" * 50_000 + ">" + body
    assert extract.main_text(many + "</p>") in (body, "")


def test_the_cut_decides_on_pages_without_names():
    """Lines too short to count as text by themselves stay between paragraphs;
    a menu's links go, and so does the short line among them."""
    long = "This is a paragraph of the story with quite a number of words in it, enough of them to be told from a menu."
    page = (f"<body><ul><li><a href=a>Home</a><li>or<li><a href=b>News of today</a></ul><div><p>{long}</p><p>And then</p><p>{long}</p>"
            f"<p>silence</p><p>{long}</p></div>")
    found = extract.blocks(page)
    costs = [b.cost for b in found]
    keep = extract.minimum_cut(costs, extract._edges(found))
    assert [b.text for b, k in zip(found, keep) if k] == [long, "And then", long, "silence", long]
    assert sum(k != (c > 0) for c, k in zip(costs, keep)) == 2


def test_broken_markup_and_odd_rows(spark):
    deep = "<div>" * 20_000 + "<p>Words at the bottom of it, quite a few of them in fact.</p>"
    many = "<article>" + "".join(f"<p>Paragraph number {i}, with a few words more.</p>" for i in range(20_000))
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (None, "u", "plain < text & no > tags", "x"),
            (3, "u", "<article><p>Cut &am", "x"), (4, "u", "<article><p>Words and words.<script>never closed", "x"),
            (5, "u", "<article><p>One.</p><p class=\"a", "x"), (6, "u", deep, "x"), (7, "u", many, "x"), (8, "u", "<!-- open", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    out = extract.extract(df).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    text = {r.page_id: r.text for r in out}
    assert text[1] == text[2] == text[8] == "" and text[3] == "Cut &am" and text[4] == "Words and words." and text[5] == "One."
    assert text[6].startswith("Words at the bottom") and text[7].count("\n") == 19_999
    assert extract.extract(df.limit(0)).count() == 0


def test_registered_gives_the_article(spark):
    d = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in queries.op1_main_text(spark, d).collect()}
    for r in queries.table(spark, d, "pages").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*(>|$)", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", body)]
        assert got[r.page_id] == "\n".join(x for x in parts if x)


def test_unclosed_and_self_closing_elements():
    text = "These are the words of the story, long enough to count as text. And one more."
    story = f"<div><p>{text}</p></div>"
    for page in (f"<body>{story}<svg class='icon'/>{story}</body>", f"<body><math/>{story}</body>", f"<body><p><svg/></p>{story}",
                 f"<!DOCTYPE html><html><head><meta charset=utf-8><title>T</title><style>p > a {{}}</style>{story}",
                 f"<head><title>T</title>\n<p>{text}", f"<body><form><button>Send</form>{story}</body>",
                 f"<body><div><select><option>One<option>Two</div>{story}</body>", f"<body><div><object data=x></div>{story}</body>"):
        assert extract.main_text(page).split("\n")[-1] == text, page
        assert not {"T", "Send", "One", "Two"} & set(extract.main_text(page).split("\n"))
    whole = f"<body><svg><style>a</svg</style><g><path d='x'/><text>Icon</text></g></svg>{story}</body>"
    assert extract.main_text(whole) == text
