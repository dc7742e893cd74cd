import html
import math
import random
import re
import time

from conftest import SF_SMALL
from tidecast.llm.html_text import extract_text, main_text
from tidecast.llm.queries import op5_html_extraction

PARA = "A paragraph of the article with enough words in it to be read as running text by any measure."


def test_plain_article():
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
    <nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav><div class="ad">Buy things now, many things</div>
    <article><h1>Head &amp; line</h1><p>{PARA}<p><b>Bold</b>&nbsp;text &lt;p&gt; 1 < 2 &#233;<br>next</p></article><footer>&copy; someone</footer></body></html>"""
    assert main_text(page) == f"Head & line {PARA} Bold text <p> 1 < 2 é next"


def test_without_semantic_elements():
    page = f"""<body><div id="cookie-notice"><p>{PARA} Accept it.</p></div><div class="top"><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div>
    <div id="story"><p>{PARA}</p><p>{PARA} <a href=x>A link</a> too.</p><ul><li>item one of the text here<li>item two of the text here</ul></div>
    <div class="sidebar"><p>{PARA}</p></div><div id="comments"><div class="comment"><p>{PARA} I disagree.</p></div></div>
    <form><input name=q><button>Go</button></form></body>"""
    assert main_text(page) == f"{PARA} {PARA} A link too. item one of the text here item two of the text here"


def test_comments_in_articles_are_left_out():
    page = f'<main><article><p>{PARA}</p><p>{PARA}</p><section class="comments"><article class="comment"><p>{PARA} No!</p></article></section></article></main>'
    assert main_text(page) == f"{PARA} {PARA}"


def test_broken_pages():
    assert main_text("") == "" and main_text(None) == ""
    assert main_text("just text, no element") == "just text, no element"
    assert main_text("<script>never closed") == ""
    assert main_text(f"<article><p>{PARA}<p>cut off in a <a hre") == f"{PARA} cut off in a"
    assert main_text(f"<article><p><b>{PARA}</p></div></span><p>{PARA}</b></article></html>") == f"{PARA} {PARA}"
    assert main_text("<!-- <article>hidden</article> --><article><p>" + PARA + "</p><!-- open") == PARA
    assert main_text("<div>" * 20_000 + PARA) == PARA


def test_icons_and_controls():
    for icon in ('<svg class="i"/>', "<svg/>", "<svg viewBox='0 0 1 1' />", '<math display="block"/>', '<svg><path d="M0 0"/><g><path></g><title>Icon</title><text>label</text></svg>', "<svg><svg/><title/></svg>",
                 "<svg><style>a{}</style><foreignObject><p>inner</p><br></foreignObject> </svg>", "<math><mi>x</mi><mo>&lt;</mo></math>"):
        assert main_text(f"<body>{icon}<article><p>{PARA}</p>{icon}<p>in{icon}side {PARA}</p></article></body>") == f"{PARA} inside {PARA}", icon
        assert main_text(f"<body><a href=x>{icon}Home</a><article><p>{PARA}</p></article>{icon}</body>") == PARA, icon
    # unclosed: ended by the parent's end, or by a start tag
    for open_tag in ("<svg class=i/>", "<svg><path d='M0 0'>", "<math><mi>x", "<select><option>one<option>two", "<object data=x>"):
        assert main_text(f"<body><div>{open_tag}</div><article><p>{PARA}</p></article></body>") == PARA, open_tag
        assert main_text(f"<article>{open_tag}<p>{PARA}</p><p>{PARA}</p></article>") == f"{PARA} {PARA}", open_tag
    assert main_text(f"<article><p>{PARA}</p><select><option>one<option>two</select><object data=x><p>{PARA} none</p></object><p>{PARA}</p></article>") == f"{PARA} {PARA}"
    assert main_text(f"<article><p><a href=x><svg><path></a> {PARA}</p><p>{PARA}</p></article>") == f"{PARA} {PARA}"


def test_cases(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", f"<article><p>{PARA}</p></article>", "x"), (3, "u", f"<p>{PARA}</p>" * 5_000, "x"), (3, "u", "a", "x"), (3, "u", "a", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0), r.url or "", r.text, r.n_chars) for r in extract_text(df).collect())
    long = " ".join([PARA] * 5_000)
    assert got == sorted([(1, "u", "", 0), (2, "", "", 0), (0, "u", PARA, len(PARA)), (3, "u", long, len(long)), (3, "u", "a", 1), (3, "u", "a", 1)])
    assert extract_text(df.limit(0)).count() == 0


def test_whole_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = op5_html_extraction(spark, SF_SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"(?s)<article>(.*?)</article>", pages[r.page_id])[1]
        want = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner)))
        assert r.text == " ".join(want.split()) and r.n_chars == len(r.text)


def test_raw_text_is_never_read_as_markup():
    """Whatever a script, style or text area holds, the article after it comes out whole, and nothing else."""
    side = "<div class='sidebar'>buy this</div>"
    article = f"<article><p>{PARA}</p><p>It's {PARA}</p></article>"
    for name in ("script", "style", "textarea", "noscript", "template", "iframe", "title", "xmp"):
        for inner in ("<!--", "<!-- open", "document.write('<!-- ad');", "if(a<b){} // don't", "a<b don't", "x = '", 'y = "', "<a href='", "<![CDATA[", "</p>", "<article><p>inside</p>", "</", f"</{name}x>", "<"):
            for end in (f"</{name}>", f"</{name.upper()} >", f"</{name} x='1'>"):
                raw = f"<{name}>{inner}{end}"
                assert main_text(f"<body>{raw}{side}{article}</body>") == f"{PARA} It's {PARA}", raw
                assert main_text(f"<body>{side}<article>{raw}<p>{PARA}</p>{raw}<p>It's {PARA}</p></article>{raw}</body>") == f"{PARA} It's {PARA}", raw


def test_quotes_protect_only_attribute_values():
    assert main_text(f"<article><p>a<b then it's fine {PARA}</p><p>It's more text {PARA}</p></article>").endswith(f"It's more text {PARA}")
    assert main_text(f"<article><p title='a > b' data-x = \"c > 'd'\">{PARA}</p><p title=don't>{PARA}</p><p alt=\"never closed>{PARA}</p></article>") == f"{PARA} {PARA} {PARA}"
    assert main_text(f"<article {'=' * 30_000}><p>{PARA}</p></article>") == PARA


def test_headers_within_the_article_are_its_own():
    for head in ("<div class='post-header'><h1>Title here</h1></div>", "<header><h1>Title here</h1></header>", "<div id=articleHeader><h1>Title here</h1></div>"):
        page = f"<body><div class='site-header'><p>{PARA}</p></div><header>Site</header><article>{head}<p>{PARA}</p></article></body>"
        assert main_text(page) == f"Title here {PARA}", head
    assert main_text(f"<article><p>{PARA}</p><div class='share-header'>Share</div><p>{PARA}</p></article>") == f"{PARA} {PARA}"


def test_deep_pages_take_linear_time():
    for page in ("<div>" * 20_000 + "</b>" * 20_000, "<b>" + "<div>" * 20_000 + "</b>" * 20_000, "<p>" + "<i>" * 20_000 + "<div>" * 20_000, "<ul><li>" + "<div>" * 20_000 + "<li>" * 20_000):
        start = time.process_time()
        assert main_text(page + PARA) == PARA
        assert time.process_time() - start < 3


# --- composite text density against a recursion over the tree itself ------------------

class Node:
    def __init__(self, name, items):
        self.name, self.items = name, []  # text, ("a", text) or Node
        for x in items:  # text beside text is one piece
            if isinstance(x, str) and self.items and isinstance(self.items[-1], str):
                self.items[-1] += x
            else:
                self.items.append(x)
        self.children = [x for x in items if isinstance(x, Node)]

    def all(self):
        return [self, *[n for c in self.children for n in c.all()]]

    def html(self):
        inner = "".join(x if isinstance(x, str) else x.html() if isinstance(x, Node) else f"<a href=x>{x[1]}</a>" for x in self.items)
        return f"<{self.name}>{inner}</{self.name}>"

    def count(self):
        """Characters, those in links, tags, link tags."""
        texts = [(len(" ".join(x.split())), 0) if isinstance(x, str) else (len(" ".join(x[1].split())),) * 2 for x in self.items if not isinstance(x, Node)]
        links = sum(isinstance(x, tuple) for x in self.items)
        own = (sum(c for c, _ in texts), sum(l for _, l in texts), 1 + links, links)
        return tuple(map(sum, zip(own, *[c.count() for c in self.children])))


def by_recursion(body):
    whole = body.count()
    share = whole[1] / max(whole[0], 1)

    def density(n):
        c, lc, t, lt = n.count()
        if not c:
            return 0.0
        return c / t * math.log1p(c / max(lc, 1) * t / max(lt, 1)) / math.log1p(math.log(c / max(c - lc, 1) * lc + share * c + math.e))

    def total(n):
        return sum(map(density, n.children)) if n.children else density(n)

    def path(n, to):
        if n is to:
            return [n]
        return next(([n, *p] for c in n.children if (p := path(c, to))), None)

    def core(n):
        return max(n.all(), key=total)

    least = min(map(density, path(body, core(body))))
    marked = {id(core(n)) for n in body.all() if density(n) >= least > 0}
    for n in body.all():
        if n is not body and any(id(c) in marked for c in n.children):
            marked |= {id(c) for c in n.children if c.name == "p" and 2 * c.count()[1] <= c.count()[0]}

    def text(n, kept):
        kept = kept or id(n) in marked
        parts = [text(x, kept) if isinstance(x, Node) else (x if isinstance(x, str) else x[1]) if kept else "" for x in n.items]
        return " " + "".join(parts) + " "

    return " ".join(text(body, False).split())


def random_tree(rng, depth):
    words = lambda a, b: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(a, b)))
    if depth == 0 or rng.random() < 0.3:
        items = []
        for _ in range(rng.randint(1, 4)):
            items.append(("a", words(1, 4)) if rng.random() < 0.35 else words(1, 40) + " ")
        return Node(rng.choice(["p", "div"]), items)
    return Node(rng.choice(["div", "section"]), [random_tree(rng, depth - 1) for _ in range(rng.randint(1, 5))])


def test_density_matches_recursion():
    rng = random.Random(11)
    several = 0
    for _ in range(400):
        body = Node("body", [random_tree(rng, rng.randint(1, 4)) for _ in range(rng.randint(1, 4))])
        want = by_recursion(body)
        assert main_text(body.html()) == want, body.html()
        several += want != " ".join(re.sub(r"<[^>]*>", " ", body.html()).split())
    assert several > 50  # parts are left out often enough for the test to mean something
