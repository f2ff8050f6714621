"""Link extraction: the per-page scanners and the strict ingest of the fixture."""

import pytest
from pyspark.sql import functions as F

from linkgraph.functions import decode_href, link_target
from linkgraph.operators.extract import equals_ignore_case, scan_html, scan_xml

BODY = ("div", "id", "bodyContent")


def test_scan_xml_scope_and_depth():
    doc = ('<r><a href="out"/><div id="bodyContent"><p><a href="x"/></p><a>no</a>'
           '<div id="bodyContent"><a href="y"/></div><a href="z"/></div><a href="out2"/></r>')
    assert scan_xml(doc, *BODY) == ["x", "y", "z"]


def test_scan_xml_rejects_ill_formed_and_keeps_nothing():
    assert scan_xml('<div id="bodyContent"><a href="x"></div>', *BODY) is None
    assert scan_xml("", *BODY) is None
    assert scan_xml("<a/><b/>", *BODY) is None
    assert scan_xml(None, *BODY) is None


def test_scan_xml_case_rules():
    # tag and value case-insensitive; attribute names exact
    assert scan_xml('<DiV id="BODYcontent"><A href="x"/></DiV>', *BODY) == ["x"]
    assert scan_xml('<div ID="bodyContent"><a href="x"/></div>', *BODY) == []
    assert scan_xml('<div id="bodyContent"><a HREF="x"/></div>', *BODY) == []


def test_scan_xml_ignores_declared_encoding_and_loads_no_dtd():
    doc = ('<?xml version="1.0" encoding="ISO-8859-1"?><!DOCTYPE r SYSTEM "http://nowhere/x.dtd">'
           '<r><div id="bodyContent"><a href="ü"/></div></r>')
    assert scan_xml(doc, *BODY) == ["ü"]


def test_equals_ignore_case():
    assert equals_ignore_case("DIV", "div")
    assert not equals_ignore_case(None, "div")
    assert not equals_ignore_case("divs", "div")


def test_scan_html_counts_container_only():
    doc = ('<html><p>open<nav><ul><li><a href="/a">a</a><br><nav><a href="/b">b</a></nav>'
           '<a href="/c?x=1&amp;y=2">c</a></ul></nav><a href="/out">o</a><script>var s="<nav>";</script>')
    assert scan_html(doc, "nav", None, None) == ["/a", "/b", "/c?x=1&y=2"]


def test_decode_and_capture(spark):
    cases = ["./a/b/C.html", "../u~v/Foo.html", "../x/Y~Z.html", "./a/.html", ".html",
             "http://h/a.html", "../x/Y.html#s", "../x/Y.HTML", "./G%20H.html", "./Q%ZZ.html",
             "./a+b.html", "./%7Ex.html", "./a%2Fb.html"]
    df = spark.createDataFrame([(c,) for c in cases], "h string")
    got = dict(df.select("h", link_target(decode_href("h")).alias("t")).collect())
    assert got == {
        "./a/b/C.html": "C", "../u~v/Foo.html": "Foo", "../x/Y~Z.html": None, "./a/.html": "a/",
        ".html": None, "http://h/a.html": None, "../x/Y.html#s": None, "../x/Y.HTML": None,
        "./G%20H.html": "G H", "./Q%ZZ.html": "Q%ZZ", "./a+b.html": "a b", "./%7Ex.html": None,
        "./a%2Fb.html": "b",
    }


def test_wiki14_outcomes(wiki14):
    report = dict(wiki14.report().collect())
    assert report == {"ok": 9, "bad_name": 2, "ill_formed": 2, "no_delimiter": 1}
    links = sorted((r.page, r.target) for r in wiki14.links.collect())
    assert links == sorted([
        ("A", "B"), ("A", "C"), ("B", "C"), ("B", "C"), ("C", "A"), ("C", "C"),
        ("E", "G H"), ("E", "Q%ZZ"), ("E", "R@amp;amp;D"), ("A", "D"),
        ("G", "A"), ("G", "B"), ("G", "C")])
    rejects = sorted((r.line, r.reason) for r in wiki14.rejects().collect())
    assert all(r.line is not None for r in wiki14.rejects().collect())
    assert ("nodelimiter", "no_delimiter") in rejects
    assert ("Cat:Foo:<html/>", "ill_formed") in rejects
    assert len(rejects) == 5


def test_wiki14_graph(wiki14):
    from linkgraph.operators import graph as G

    g = wiki14.graph
    nodes = {r.id: r for r in G.node_table(g).collect()}
    assert len(nodes) == 11
    assert g.edges.count() == 13
    assert sorted(i for i, r in nodes.items() if r.dangling) == sorted(
        ["D", "H", "I", "G H", "Q%ZZ", "R@amp;amp;D"])
    assert g.n_records() == 9
    pairs = {(r.src, r.dst): r.mult for r in G.edge_pairs(g).where(F.col("src") == "A").collect()}
    assert pairs == {("A", "B"): 1, ("A", "C"): 1, ("A", "D"): 1}


def test_lenient_pages_without_container_skip_python(spark):
    from linkgraph.plans.jobs import ingest_pages

    pages = spark.createDataFrame([
        ("a", '<html><p><a href="/x">no nav here</a></p></html>'),
        ("b", '<html><NAV><a href="/y">y</a></NAV></html>'),
        ("c", None),
    ], "page string, html string")
    ing = ingest_pages(pages)
    assert {r.page: r.reason for r in ing.extracted.collect()} == {"a": "ok", "b": "ok", "c": "ill_formed"}
    assert [(r.page, r.target) for r in ing.links.collect()] == [("b", "y")]


def test_scan_html_container_with_attribute():
    doc = ('<div id="side"><a href="/no">x</a></div>'
           '<DIV ID="MAIN"><div><a href="/a">a</a></div><p>unclosed<a href="/b">b</a></DIV>'
           '<a href="/after">y</a><div id="main"><a href="/c">c</a></div>')
    # nested divs count toward the container's depth; attribute names are case-free in HTML
    assert scan_html(doc, "div", "id", "main") == ["/a", "/b", "/c"]


def test_scan_html_accepts_any_text():
    import random

    rng = random.Random(1)
    parts = ["<", ">", "/", "!", "--", "[", "<nav>", "</nav>", '<a href="/x">', '"', "'", "=", " ", "a", "href", "&amp;", "<![",
             "CDATA[", "]]>", "<!", "<?", "<script>", "</script>", "\n", "<title>", "&#x110000;", "\x00"]
    for _ in range(100_000):
        scan_html("".join(rng.choices(parts, k=rng.randrange(1, 12))), "nav", None, None)


def test_scan_html_is_linear():
    import time

    for unit in ("<a ", "<!--", "<a x='", '<a x="', "<", "</", "<![", "&", "<a '=\"'", '<a x="\'>', "<a x='>' ", "<title", "<!-->"):
        start = time.perf_counter()
        scan_html("<nav>" + unit * 300_000, "nav", None, None)
        assert time.perf_counter() - start < 10, unit


@pytest.mark.parametrize("unit", ["<", "<1", "< ", "<<a", "</", "</1", "<!", "<?", "<=>"])
def test_scan_html_many_openings_before_one_end(unit):
    """The next '>' is found once, not anew at every '<'."""
    import time

    start = time.perf_counter()
    assert scan_html("<nav>" + unit * (2_000_000 // (1 + unit.count("<"))) + "><a href='/x'>", "nav", None, None) is not None
    assert time.perf_counter() - start < 2, unit


def test_scan_html_time_grows_with_the_length_only():
    """Random units from the characters that steer the scanner: four times the text, about four times the time."""
    import random
    import time

    rng = random.Random(5)
    for _ in range(25):
        unit = "".join(rng.choice(["<", ">", "a", "nav", "/", "!", "--", "?", "=", "'", '"', " ", "<a href=/x", "title", "script"])
                       for _ in range(rng.randrange(1, 7)))
        times = []
        for n in (15_000, 60_000):
            text = "<nav>" + unit * n
            start = time.perf_counter()
            scan_html(text, "nav", None, None)
            times.append(time.perf_counter() - start)
        assert times[1] < 12 * times[0] + 0.1, (unit, times)


def test_strict_parse_of_a_very_long_page_holds_no_encoded_copy():
    """200 M characters: the parser is fed pieces, so memory stays near the page's own."""
    import resource

    page = '<div id="x">' + "text " * 40_000_000 + '<a href="./X.html"/></div>'
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert scan_xml(page, "div", "id", "x") == ["./X.html"]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 50_000     # KB


def test_strict_parse_cuts_anywhere(monkeypatch):
    from linkgraph.operators import extract

    page = '<div id="bodyContent"><a href="./\u00e9\u65e5\U0001f600.html">x</a><!-- c --><![CDATA[<a href="no">]]></div>'
    want = scan_xml(page, "div", "id", "bodyContent")
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(extract, "PIECE", size)
        assert scan_xml(page, "div", "id", "bodyContent") == want == ["./\u00e9\u65e5\U0001f600.html"]
        assert scan_xml(page[:-1], "div", "id", "bodyContent") is None


# What this parser says of documents at the edges of XML, next to what the XML 1.0 recommendation
# (and so a conforming XML parser) says. README names the rows where they differ.
CONFORMANCE = [
    ("empty text", "", False, False),
    ("white space only", " \n", False, False),
    ("text after the root", "<a/>x", False, False),
    ("two roots", "<a/><b/>", False, False),
    ("comment after the root", "<a/><!-- c -->", True, True),
    ("double hyphen in a comment", "<a><!-- x -- y --></a>", False, False),
    ("CDATA end in text", "<a>]]></a>", False, False),
    ("less-than in an attribute", '<a b="<"/>', False, False),
    ("repeated attribute", '<a b="1" b="2"/>', False, False),
    ("attributes without space between", '<a b="1"c="2"/>', False, False),
    ("unquoted attribute", "<a b=1/>", False, False),
    ("attribute without value", "<a b/>", False, False),
    ("declaration not at the start", ' <?xml version="1.0"?><a/>', False, False),
    ("declaration without version", '<?xml encoding="UTF-8"?><a/>', False, False),
    ("processing instruction named xml", "<a><?xml x?></a>", False, False),
    ("control character", "<a>\x01</a>", False, False),
    ("U+0085 in text", "<a>\x85</a>", True, True),
    ("U+FFFF in text", "<a>\uffff</a>", False, False),
    ("undefined entity", "<a>&nope;</a>", False, False),
    ("external DTD not loaded", '<!DOCTYPE a SYSTEM "http://h/x.dtd"><a/>', True, True),
    ("undefined entity, external DTD", '<!DOCTYPE a SYSTEM "http://h/x.dtd"><a>&nope;</a>', True, True),
    ("internal entity", '<!DOCTYPE a [<!ENTITY e "v">]><a>&e;</a>', True, True),
    ("entity that names itself", '<!DOCTYPE a [<!ENTITY e "&e;">]><a>&e;</a>', False, False),
    ("name that starts with a digit", "<1a/>", False, False),
    ("name of the fifth edition only", "<\u0220/>", False, True),
    ("unbound prefix", "<p:a/>", True, True),
    ("declared as XML 1.1", '<?xml version="1.1"?><a/>', True, True),
    ("XML 1.1 control reference", '<?xml version="1.1"?><a>&#1;</a>', False, True),
    ("unknown declared encoding", '<?xml version="1.0" encoding="x-none"?><a/>', True, True),
    ("carriage return in an attribute", '<a b="x\ry"/>', True, True),
]


@pytest.mark.parametrize("what,doc,ours,standard", CONFORMANCE, ids=[c[0] for c in CONFORMANCE])
def test_conformance_table(what, doc, ours, standard):
    assert (scan_xml(doc, "a", None, None) is not None) == ours


def test_scan_html_keeps_links_around_bad_sections():
    assert scan_html('<nav><a href="/a">x</a><![foo[ x</nav><nav><a href="/b">', "nav", None, None) == ["/a", "/b"]
    assert scan_html('<nav><a href="/a"><!-- open ><a href="/b">', "nav", None, None) == ["/a", "/b"]
    assert scan_html('<nav><a href="/a"><p title="open><a href=\'/b\'>', "nav", None, None) == ["/a", "/b"]
    assert scan_html("<nav><a href=/u?x=1&y=2&copy=3&copyx&copy;&#65;>", "nav", None, None) == ["/u?x=1&y=2&copy=3&copyx©A"]
    assert scan_html('<nav><a x=">" href="/a"><!--<a href="/no">--><a/href=/b><A HREF = "/c" href="/d"><a href>', "nav", None, None) == ["/a", "/b", "/c"]


def test_ill_formed_pages_do_not_end_a_lenient_job(spark):
    from linkgraph.plans.jobs import ingest_pages

    pages = spark.createDataFrame([("a", '<nav><a href="/x"><![foo[ x</nav>'), ("b", '<nav><a href="/y">')], "page string, html string")
    assert sorted(r.target for r in ingest_pages(pages).links.collect()) == ["x", "y"]


def test_page_tables_follow_the_name_rule(spark):
    from linkgraph.operators.rank import rank_nodes
    from linkgraph.plans.jobs import ingest_pages

    link = '<nav><a href="/p2">x</a></nav>'
    pages = spark.createDataFrame([(None, link), ("", link), ("a~b", link), ("p1", link), ("p1", None)], "page string, html string")
    ing = ingest_pages(pages)
    assert dict(ing.report().collect()) == {"bad_name": 3, "ok": 1, "ill_formed": 1}
    ranks = {r.id: r.rank for r in rank_nodes(ing.graph).collect()}
    assert set(ranks) == {"p1", "p2"} and abs(sum(ranks.values()) - 1) < 1e-12


def test_pages_without_a_name_are_no_vertices(spark):
    from linkgraph.operators.graph import Graph, node_table, node_universe

    edges = spark.createDataFrame([("a", "b"), (None, "c"), ("d", None)], "src string, dst string")
    graph = Graph(edges, pages=spark.createDataFrame([(None,), ("p",)], "id string"))
    assert sorted(r.id for r in node_table(graph).collect()) == sorted(r.id for r in node_universe(graph).collect()) == ["a", "b", "p"]
