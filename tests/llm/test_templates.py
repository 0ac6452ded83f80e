import random

import pytest

from tableferry.llm.templates import TEXT_BLOCK, Node, blocks, extract, main_text, parse, subtrees

SCHEMA = "page_id long, url string, html string"


def text(html):
    root = parse(html)
    subtrees(root)
    return blocks(root, frozenset())


def test_blocks_of_an_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li>x</ul></nav>
    <!-- ad <p>no</p> --><div class="ad">buy</div><article class="post with-sidebar"><header>h</header><h1>Head</h1><p><b>One &amp; two&nbsp;\n three.<br>four<p>Five.</p>
    <div id="comments"><p>nice</p></div><aside>s</aside><form><p>mail</p></form><ul><li>a<li>b</ul><p hidden>no</p></article><p>outside</p><footer>&copy;</footer>"""
    assert text(page) == "Head\n\nOne & two three. four\n\nFive.\n\na\n\nb"


def test_pages_without_an_article():
    assert text("<body><div class='navbar'>x</div><main><p>a</p>b<p>c</main><p>d") == "a\n\nb\n\nc"
    assert text("plain &lt;text&gt; <i>in</i>line") == "plain <text> inline"
    assert text("<p>a < b and c <3</p><p>d</p>") == "a < b and c <3\n\nd"
    assert text("") == text("<script>if (a</b) x</script>") == ""


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], f"{SCHEMA}, text string, host string, page string")


@pytest.mark.parametrize("held", [0, 1000])
def test_what_recurs_on_a_host_goes(spark, held):
    """Boxes and paragraphs of all pages go; lines that few pages share, and other hosts' pages, stay."""
    body = lambda i: f"<div class='body'><p>Own text {i}.</p><p>A line of every page.</p>" + "<p>A line of few.</p>" * (i < 4) + "</div>"
    bar = "<div class='top'><span>Our</span> <b>site</b></div><div>Terms of use</div>"
    rows = [(i, "http://h.org/%d" % i, bar + body(i)) for i in range(10)]
    rows += [(20, "http://other.org/", bar + body(20)), (21, None, None), (None, "http://h.org/x", bar + body(3)), (22, "http://h.org/", "x" * 200_000)]
    got = {r.page_id: r for r in extract(spark, pages(spark, rows), held=held).collect()}
    for i in range(10):
        assert got[i].text == f"Own text {i}." + "\n\nA line of few." * (i < 4)
    assert got[None].text == got[3].text and got[21].text == "" and got[22].n_chars == 200_000
    assert got[20].text == "Our site\n\nTerms of use\n\nOwn text 20.\n\nA line of every page."
    assert extract(spark, spark.createDataFrame([], SCHEMA), held=held).count() == 0


@pytest.mark.parametrize("held", [0, 1000])
def test_menus_in_tables_and_unmarked_notices_go(spark, held):
    page = lambda i: (
        "<table><tr><td><div>Home</div><div>News</div></td><td><p>We use your data.</p>"
        f"<p>First words {i}.</p><ul><li>Point {i}</li><li>Subscribe now</li></ul><p>Last words {i}.</p></td></tr></table>"
    )
    got = extract(spark, pages(spark, [(i, f"http://h.org/{i}", page(i)) for i in range(20)]), held=held).collect()
    assert {r.page_id: r.text for r in got} == {i: f"First words {i}.\n\nPoint {i}\n\nLast words {i}." for i in range(20)}


def test_classes_go_by_their_whole_name():
    own = '<div class="%s"><p>Own words here.</p></div><div>Foot</div>'
    for name in ("social-history", "share-price", "notice-of-award", "post with-sidebar", "headerless", "comment1x-study"):
        assert text(own % name) == "Own words here.\n\nFoot"
    for name in ("ad", "ad-slot", "cookie-notice", "commentList", "site-footer", "page_header left", "widget-area", "x sidebar"):
        assert text(own % name) == "Foot"


def test_a_page_all_of_which_recurs_is_a_copy_and_stays(spark):
    body = lambda i: f"<article><p>The same report.</p><p>Its second part.</p></article><div>{'footer ' * i}</div>"
    got = extract(spark, pages(spark, [(i, f"http://h.org/{i}", body(i)) for i in range(12)])).collect()
    assert {r.text for r in got} == {"The same report.\n\nIts second part."}


def by_counting(rows, least_pages, least_share, text_share):
    """Subtrees as nested tuples, counted in a dictionary."""

    def shape(node):
        return node.tag, tuple(shape(p) if isinstance(p, Node) else " ".join(p.split()) for p in node.parts)

    def filled(s):
        return any(filled(p) if isinstance(p, tuple) else p for p in s[1])

    def walk(node, inside, out):
        inside = inside or node.tag in TEXT_BLOCK
        if filled(shape(node)) and node.tag not in ("#root", "html", "body", "main", "article") and not node.drop:
            out.append((node, (shape(node), inside)))
        for p in node.parts:
            if isinstance(p, Node):
                walk(p, inside, out)
        return out

    host = lambda url: url.split("://")[1].split("/")[0]
    seen, of_host = {}, {}
    for _, url, html in rows:
        of_host.setdefault(host(url), set()).add(html)
        for _, kind in walk(parse(html), False, []):
            seen.setdefault((host(url), kind), set()).add(html)
    out = {}
    for i, url, html in rows:
        root = parse(html)
        subtrees(root)
        n = len(of_host[host(url)])
        nodes = {node.index for node, kind in walk(root, False, []) if (k := len(seen[host(url), kind])) >= least_pages and k >= (text_share if kind[1] else least_share) * n}
        out[i] = main_text(root, frozenset(nodes))
    return out


@pytest.mark.parametrize("held", [0, 10_000])
def test_made_sites_against_a_plain_counter(spark, held):
    draw = random.Random(4)
    kinds = [f"<div>menu {k}</div>" for k in range(4)] + [f"<p>notice {k}</p>" for k in range(4)] + [f"<ul><li>link {k}</li><li>more</li></ul>" for k in range(3)] + ["<table><tr><td><span>Home</span></td></tr></table>"]
    rows = []
    for i in range(150):
        parts = [k for j, k in enumerate(kinds) if draw.random() < 1 / (1 + j % 4)] + [f"<p>own {draw.randrange(120)}</p>" for _ in range(3)] + [f"<div><p>own {i}</p><b>x</b></div>"]
        draw.shuffle(parts)
        rows.append((i, f"http://h{draw.randrange(3)}.org/{i}", "<body>" + "".join(parts) + "</body>"))
    got = {r.page_id: r.text for r in extract(spark, pages(spark, rows), 5, 0.1, 0.4, held).collect()}
    want = by_counting(rows, 5, 0.1, 0.4)
    assert got == want
    plain = {i: blocks(parse(html), frozenset()) for i, _, html in rows}
    assert sum(got[i] != plain[i] for i in got) > 100, "the counts decide"


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, "http://h.org/a", "<div><div>Once told</div></div>") for i in range(30)]
    assert {r.text for r in extract(spark, spark.createDataFrame(rows, SCHEMA)).collect()} == {"Once told"}
