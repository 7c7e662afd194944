"""Pages as elements and pieces of text, and the rules that read them."""

import contextlib
import io

import pytest

from hearthline.functions import elements as X
from hearthline.functions import pages as pages_of
from hearthline.functions.pages import read_page
from hearthline.operators import extract

HTML = "source string, url string, html string"
PAGE = """<title>T</title><div id="side" class="box wide"><p>one<p class="a">two <b>three</b></div>
<ul><li class="a">x</li><li>y<ul><li class="a">z</ul></ul><script>if (a < b) {"hidden"}</script>
<i class="mark"></i> loose <span data-kind="v w">next</span><img class="a"><h2>Label</h2>"""


def test_elements_of_a_page():
    elements, pieces = read_page(PAGE, frozenset(["data-kind"]))
    assert pieces == ["T", "one", "two", "three", "x", "y", "z", "loose", "next", "Label"]
    of = {(e[5], e[3]): e for e in elements}
    assert [e[0] for e in elements] == list(range(len(elements))) and elements[0][2] == len(elements) - 1 and elements[0][11] == len(pieces)
    assert of["div", 1][6] == [".box", ".wide", "#side"] and of["span", 1][6][:1] != ["."] and "data-kind=v w" in of["span", 1][6]
    assert all(e[1] <= e[0] <= e[2] <= elements[e[1]][2] and e[10] <= e[11] for e in elements)
    assert read_page(None, frozenset()) == read_page("", frozenset()) and len(read_page("", frozenset())[0]) == 1


@pytest.fixture(scope="module")
def read(spark):
    pages = spark.createDataFrame([("s", "u", PAGE), ("s", "v", None), ("s", "w", "<p>" * 3000 + "deep" + '<a href="/x">y</a>')], HTML)
    table = extract.page_elements(pages, X.attribute_names(("[data-kind]", ("first", "span[data-kind=x]")))).orderBy("url").cache()
    return lambda expression: [r[0] for r in table.selectExpr(expression).collect()]


@pytest.mark.parametrize(
    ("rule", "text"),
    [
        (("first", ".a"), "twothree"), (("first", "ul li.a"), "x"), (("first", "ul li", 2), "z"), (("first", "ul>li>ul>li"), "z"), (("first", "li+li"), "yz"), (("first", "#side>p.a"), None),
        (("first", "#side p.a b"), "three"), (("first", "span[data-kind]"), "next"), (("first", "span[data-kind='v w']"), "next"), (("first", "span[data-kind=v]"), None), (("with_next", ".mark"), "next"), (("with_next", "h2"), None),
        (("nth_of_kind", "li", 2), "yz"), (("first_with", "li", ("y",)), None), (("first_with", "li", ("x", "q")), "x"), (("label_sibling", "li", "YZ", "!"), "x!"), (("contains_any", "p b", ("three",), 5, (), None), None),
        (("contains_any", "p b", ("three",), 6, (), "p"), "three"), (("contains_any", "li", ("z",), 9, ("h9", "ul"), None), None), (("contains_any", "li", ("z",), 9, ("title", "ul"), None), "yz"), (("short_keyword_digit", "li", ("x",)), None), (("canonical",), None),
    ],
)
def test_rules(read, rule, text):
    assert read(X.field([rule])) == [text, None, None]


def test_paths_and_links(read):
    assert read(X.links([("p", False)])) == [[[]], [[]], [["/x"] * 3000]] and read(f"size({X.select('p p')})") == [1, 0, 2999]
    with pytest.raises(ValueError, match="not a step"):
        X.select("a:hover")


def test_digits_count_in_all_scripts(spark):
    texts = ["$ ٣", "$ ²", "$ ①", "$ x", "USD7", "7 USD"]
    pages = spark.createDataFrame([("s", str(i), f"<b>{t}</b>") for i, t in enumerate(texts)], HTML)
    out = extract.page_elements(pages, frozenset()).orderBy("url").selectExpr(X.starts_with_digit("b", ("$", "USD"))).collect()
    assert [r[0] for r in out] == ["$ ٣", "$ ²", "$ ①", None, "USD7", None]


def test_a_page_that_cannot_be_read_keeps_its_error(spark):
    url = "https://privateproperty.ng/listings/short-let-6PBUWY"
    pages = spark.createDataFrame([("privateproperty", url, b"<strong>$ 5</strong>"), ("privateproperty", url, None)], "source string, url string, html binary")
    good, quarantine = extract.extract_listings(pages)
    assert good.count() == 0 and sorted(r.reason.split(":")[0] for r in quarantine.collect()) == ["TypeError", "no price"]


def test_plain_pages_are_read_without_the_parser_and_alike(monkeypatch):
    """Of plain tags and text, the parser is not asked; what it would have given is the same, and other pages go to it."""
    names, asked = frozenset(["rel", "data-kind"]), []
    plain = ["", "x", "<p>a<p CLASS='a  b' id=i>", '<div class="a &amp; b"><br/><img src="u"/>&lt;b &amp; c</div> > </p></div>', "<i data-kind rel='x y'>1</i><i rel=\"\">2</i><I>3</i><div/><u>4</b></u>"]
    other = ["a < b", "<p><!-- c -->d", "<title>&lt;</title>", "<a href='x>y'>z</a>", "<script>1<2</script>", "<p a=b>c", "<a href='x>", "</p x>y"]
    init = pages_of._Reader.__init__

    def parsed(page):
        reader = pages_of._Reader(names)
        reader.feed(page), reader.close(), reader.leave(0)
        return [[*e[:6], set(e[6]), *e[7:]] for e in reader.elements], reader.pieces

    want = {page: parsed(page) for page in plain + other}
    monkeypatch.setattr(pages_of._Reader, "__init__", lambda self, n: asked.append(1) or init(self, n))
    for page in [*plain, *other, *plain]:
        elements, pieces = read_page(page, names)
        assert ([[*e[:6], set(e[6]), *e[7:]] for e in elements], pieces) == want[page], page
    assert len(asked) == len(other) + 2  # an id without quotes is not plain, each time


def test_quarantine_reads_what_decides_alone(spark):
    page = spark.createDataFrame([("jiji", "https://jiji.ng/a", "<h1>t</h1>")], HTML)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        extract.extract_listings(page)[1].explain()
    assert "b-seller-block__name" not in plan.getvalue() and extract.extract_listings(page)[1].first().reason == "no external id"
