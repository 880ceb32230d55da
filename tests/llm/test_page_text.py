from pyspark.sql import functions as F

from quayside.llm import page_text as pt

HEAD = '<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script>'
MENU = "<nav><ul><li><a href=/a>home</a></li></ul></nav>"
STOCK = " ".join(f"stock{i}" for i in range(14))


def texts(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("own") for c in ("text", "host", "page", "key", "hits", "block")})
    return sorted(((r["page_id"], r["text"]) for r in pt.extract(df, **options).collect()), key=str)


def test_article():
    page = (HEAD + "</head><body>" + MENU + '<!-- x --><div class="ad">buy</div><article><h1>A &amp; B'
            "</h1><p><b>one<br>two</b>\n three<p>four<i>five</i></article><footer>f</footer></body>")
    assert pt.blocks(page) == [("frame", "home"), ("frame", "buy"), ("main", "A & B"),
                               ("main", "one two three"), ("main", "fourfive"), ("frame", "f")]


def test_parts_to_leave_out():
    page = ('<main><header><h1>T</h1></header><p>a</p><aside>x</aside><form>y<input></form>'
            '<div id="comments"><p>c</p></div><div role=navigation>n</div><p>b &lt; c &#x41;</p>'
            '<section class="cookie-notice">k</section></main>')
    assert [t for k, t in pt.blocks(page) if k == pt.MAIN] == ["T", "a", "b < c A"]


def test_broken_markup():
    assert pt.blocks("<nav><ul><li>m<article><p>t</article>") == [("frame", "m"), ("main", "t")]
    assert pt.blocks("<article><p>t <b") == [("main", "t")]
    assert pt.blocks("a < b & c &amp") == [("open", "a < b & c &")]
    assert pt.blocks("<!-- open") == [] and pt.blocks("<script>x") == [] and pt.blocks(None) == []
    assert pt.blocks('<p title="a>b">c</p>') == [("open", "c")]


def test_unclosed_and_self_closed_elements_swallow_nothing():
    for tag in ("<svg a=b />", "<object data='x' />", "<iframe src='x' />", "<svg-icon>",
                "<template />", "<button>", "<select>", "<title-bar>"):
        page = f"<article><p>one {tag}two</p><p>three</p></article>"
        assert " ".join(t for k, t in pt.blocks(page) if k == pt.MAIN) == "one two three", tag
    assert pt.blocks("<article>a <button><div>b</div></button>c<svg><svg>d</svg>e</svg>"
                     "<select><option>f</select></article>") == [("main", "a c")]
    assert pt.blocks("<article>a<svg>b</article><aside>c</svg>d</aside>") == [
        ("main", "ab"), ("frame", "cd")]
    assert pt.blocks("<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p>") == [
        ("open", "let x=1 be")]


def test_repeated_runs_leave_open_pages(spark):
    page = "<body><div><p>{own}</p><p>" + STOCK + "</p></div></body>"
    rows = [(i, f"http://{'a' if i < 3 else 'b'}.com/{i}", page.replace("{own}", f"own text {i}"))
            for i in range(4)]
    rows.append((9, None, page.replace("{own}", "nine")))
    assert texts(spark, rows) == [(0, "own text 0"), (1, "own text 1"), (2, "own text 2"),
                                  (3, f"own text 3\n{STOCK}"), (9, f"nine\n{STOCK}")]


def test_articles_are_never_cut(spark):
    page = f"<article><p>{STOCK}</p></article>"
    rows = [(i, "http://a.com/", page + f"<p>{i}</p>") for i in range(3)]
    rows += [(5, "http://a.com/", f'<div class=ad>{STOCK}</div><article>own</article>')]
    assert texts(spark, rows) == [(i, STOCK) for i in range(3)] + [(5, "own")]


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>"),
            (3, "http://h/", "<article>" + "<p>word</p>" * 30_000 + "</article>")]
    got = texts(spark, rows)
    assert got[:2] == [(1, ""), (2, "x")] and got[2] == (2, "x") and got[-1] == (None, "")
    assert got[3][1].count("\n") == 29_999
    assert texts(spark, []) == []


def test_copies_of_a_page_are_one_page(spark):
    row = (2, "http://h/", f"<p>{STOCK}</p>")
    assert texts(spark, [row, row]) == [(2, STOCK)] * 2


def test_unique_runs():
    words = [f"w{i}" for i in range(30)]
    assert pt.unique_runs(" ".join(words), [5, 6]) == [" ".join(words[:5]), " ".join(words[16:])]
    assert pt.unique_runs(" ".join(words[:10]), [0]) == []
