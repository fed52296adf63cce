"""Main text of pages: generated layouts, broken markup, the driver's pages against a plain reading, odd rows."""

import html
import random
import re

import pytest

from conftest import SF_SMALL
from delaykit.llm.common import prepare_workers, table
from delaykit.llm.wrappers import Page, align, extract, parse


def text_of(source):
    page = Page(source)
    keep, _ = page.content()
    return "\n".join(b[1] for b, k in zip(page.blocks, keep) if k)


def run(spark, rows, schema="page_id long, url string, html string"):
    prepare_workers(spark)
    return {r.page_id: r for r in extract(spark.createDataFrame(rows, schema).repartition(3)).collect()}


@pytest.mark.parametrize("source,expected", [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b\n\t c<br>d</p>e", "a\nb c d\ne"),
    ("<p><b>one<br><p>two</b> three", "one\ntwo three"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<script>var a='<p>x</p>'</script><style>p{}</style><p>y<!-- <p>z</p> -->!", "y!"),
    ("<script>never closed <p>x", ""),
    ("<p>&copy; &#233; &#x41; &am; &unknown; 5 &lt; 6 < 7", "© é A &am; &unknown; 5 < 6 < 7"),
    ("<a href='x>y' title=\"<b>\">in</a> out", "in out"),
    ("<p title=\"open>text</p><p>more", "text\nmore"),
    ("<nav>menu</nav><main><h1>T</h1><aside>side</aside><p>body</main><footer>f</footer>", "T\nbody"),
    ("<header>top</header><article><header><h1>T</h1></header><p>x</p><footer>tags</footer></article><p>after", "T\nx"),
    ("<form><article><p>inside a form</article></form>", "inside a form"),
    ("<article><p>text</p><div class='comments'><article class=comment>reply</article></div></article>", "text"),
    ("<aside><article>teaser</article></aside><article>main</article>", "main"),
    ("<div class='Cookie-Notice'>we use</div><div id=sidebar-2>s</div><div class=ad>buy</div><div hidden>h</div><p>x", "x"),
    ("<p>a<span class='share'>tweet</span>b</p>", "a\nb"),
    ("<template><p>t</p></template><noscript>n</noscript><select><option>o</select><button>b</button>x", "x"),
    ("</p></div><p>stray</article> ends", "stray ends"),
])
def test_markup(source, expected):
    assert text_of(source) == expected


def test_deep_and_long_pages():
    assert text_of("<div>" * 30_000 + "deep" + "</div>" * 30_000 + "<p>end") == "deep\nend"
    page = "".join(f"<h2>{k}</h2><p>t{k}</p><b>" for k in range(3_000))
    assert text_of(page) == "\n".join(f"{k}\nt{k}" for k in range(3_000))
    row = parse(1, "u", "h", page)
    assert set(align(row[4], row[4])) == set(range(row[5])) and len(align(row[4], parse(1, "u", "h", page[:9_000])[4])) == row[5]
    assert text_of('<a "' * 20_000 + "x") is not None


def plain_matching(a, b):
    """Simple tree matching on nested tuples (label, children), by its definition."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + plain_matching(x, y))
    return 1 + m[-1][-1]


def test_alignment_is_a_largest_match():
    rng = random.Random(2)

    def tree(depth):
        return rng.choice("abc"), [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else []

    def lines(t, depth=0):
        yield f"{depth} {t[0]}"
        for c in t[1]:
            yield from lines(c, depth + 1)

    for _ in range(300):
        a, b = ("r", tree(3)[1]), ("r", tree(3)[1])
        left, right = "\n".join(lines(a)), "\n".join(lines(b))
        slots = align(left, right)
        matched = [s for s in slots if s >= 0]
        assert len(matched) == plain_matching(a, b) == len(set(matched))
        labels = [x.split()[1] for x in right.split("\n")]
        assert all(s < 0 or labels[s] == x.split()[1] for s, x in zip(slots, left.split("\n")))


def test_template_texts_and_menus_without_telling_names(spark):
    rng = random.Random(7)

    def words(n):
        return " ".join(rng.choice("abcdefghij") * rng.randint(2, 6) + str(rng.randrange(999)) for _ in range(n))

    rows, expected = [], {}
    for k in range(60):
        title, paragraphs = words(4), [words(rng.randint(8, 40)) for _ in range(rng.randint(1, 6))]
        links = "".join(f"<li><a href=/{x}>{words(1)}</a></li>" for x in range(5))
        host = "Big.example" if k % 3 else "small.example"
        rows.append((k, f"https://{host}/{k}",
                     f"<body><div class=x1><ul>{links}</ul></div><div class=x2>Welcome to {host}! Read our rules.</div>"
                     f"<div class=x3><h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}<p>Written for {host}.</p></div>"
                     f"<div class=x4>All things reserved</div></body>"))
        expected[k] = "\n".join([title, *paragraphs])
    got = run(spark, rows)
    assert {k: r.text for k, r in got.items()} == expected
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_copies_of_an_article_are_no_template(spark):
    body = "<article><h1>Copied</h1><p>" + "the same long article again and again " * 3 + "</p></article>"
    rows = [(k, "http://h.example/" + str(k), f"<nav>{k}</nav>" + body) for k in range(40)]
    rows += [(100 + k, "http://h.example/x", f"<nav>{k}</nav><article><h1>Title {k}</h1><p>Words of page {k}.</p></article>") for k in range(4)]
    got = run(spark, rows)
    assert all(got[k].text.startswith("Copied\nthe same long") for k in range(40))
    assert all(got[100 + k].text == f"Title {k}\nWords of page {k}." for k in range(4))


def test_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    from delaykit.llm import wrappers
    rows = [(k, f"http://h{k % 2}.example/{k}", f"<div>same</div><p>text {k}</p>") for k in range(20)]
    expected = {k: r.text for k, r in run(spark, rows).items()}
    assert expected == {k: f"text {k}" for k in range(20)}
    monkeypatch.setattr(wrappers, "WRAPPER_BYTES", 0)
    assert {k: r.text for k, r in run(spark, rows).items()} == expected


def test_driver_pages_against_a_plain_reading(spark):
    prepare_workers(spark)
    pages = table(spark, SF_SMALL, "pages")
    got = {r.page_id: r for r in extract(pages).collect()}
    for i, url, source in pages.select("page_id", "url", "html").collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert (got[i].url, got[i].text) == (url, "\n".join(b for b in blocks if b))


def test_cases(spark):
    schema = "page_id long, url string, html string, host string, text string, kind int, slot int, n_chars int"
    long = "<p>" + "long words " * 200_000
    rows = [(1, "http://a.example/", None), (2, None, ""), (3, "no url", "<p>x"), (4, "http://[bad", "<p>y"), (None, None, None),
            (5, "http://a.example/1", "<p>same"), (5, "http://a.example/1", "<p>same"), (2 ** 62 + 1, "http://a.example/2", long)]
    got = extract(spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], schema).repartition(3))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = sorted((str(r.page_id), r.text) for r in got.collect())
    assert texts == sorted([("1", ""), ("2", ""), ("3", "x"), ("4", "y"), ("None", ""), ("5", "same"), ("5", "same"),
                            (str(2 ** 62 + 1), ("long words " * 200_000).strip())])
    assert extract(spark.createDataFrame([], schema)).count() == 0
