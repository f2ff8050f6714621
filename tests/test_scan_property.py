"""Property test of the strict scanner against a tree rule computed independently.

For a well-formed document, a link is in scope exactly when some ancestor of
its anchor is a container (tag and id value compared without case, the
attribute name exactly). Random trees check the scanner's depth counting,
nested and repeated containers, case rules and missing hrefs.
"""

from xml.sax.saxutils import quoteattr

from hypothesis import given, settings
from hypothesis import strategies as st

from linkgraph.operators.extract import scan_xml

TAGS = ["div", "DIV", "Div", "a", "A", "p", "span"]
IDS = [None, "bodyContent", "BODYCONTENT", "bodycontent", "other"]


@st.composite
def trees(draw, depth=0):
    tag = draw(st.sampled_from(TAGS))
    attrs = {}
    ident = draw(st.sampled_from(IDS))
    if ident is not None:
        attrs[draw(st.sampled_from(["id", "id", "ID"]))] = ident
    if tag.lower() == "a" and draw(st.booleans()):
        attrs[draw(st.sampled_from(["href", "href", "HREF"]))] = draw(
            st.text(alphabet="abc./~%", min_size=0, max_size=6))
    kids = [] if depth >= 4 else draw(st.lists(trees(depth=depth + 1), max_size=3))
    return (tag, attrs, kids)


def render(node) -> str:
    tag, attrs, kids = node
    a = "".join(f" {k}={quoteattr(v)}" for k, v in attrs.items())
    return f"<{tag}{a}>" + "".join(render(k) for k in kids) + f"</{tag}>"


def expected(node, inside=False) -> list[str]:
    tag, attrs, kids = node
    out = []
    is_container = tag.lower() == "div" and (attrs.get("id") or "").lower() == "bodycontent"
    if inside and tag.lower() == "a" and "href" in attrs:
        out.append(attrs["href"])
    for k in kids:
        out += expected(k, inside or is_container)
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(trees(), min_size=1, max_size=4))
def test_scope_equals_container_ancestry(forest):
    doc = "<root>" + "".join(render(t) for t in forest) + "</root>"
    want = [h for t in forest for h in expected(t)]
    assert scan_xml(doc, "div", "id", "bodyContent") == want


@settings(max_examples=200, deadline=None)
@given(st.lists(trees(), min_size=1, max_size=3), st.integers(min_value=1, max_value=40))
def test_any_cut_document_is_rejected(forest, cut):
    doc = "<root>" + "".join(render(t) for t in forest) + "</root>"
    assert scan_xml(doc[:-min(cut, len(doc) - 1)], "div", "id", "bodyContent") is None


HTML_TAGS = ["nav", "NAV", "a", "A", "p", "span", "div"]


@st.composite
def html_trees(draw, depth=0):
    tag = draw(st.sampled_from(HTML_TAGS))
    attrs = {}
    if tag.lower() == "a" and draw(st.booleans()):
        attrs[draw(st.sampled_from(["href", "HREF"]))] = draw(st.text(alphabet="abc/~%", max_size=5))
    kids = [] if depth >= 4 else draw(st.lists(html_trees(depth=depth + 1), max_size=3))
    return (tag, attrs, kids)


def html_expected(node, inside=False) -> list[str]:
    tag, attrs, kids = node
    out = []
    if inside and tag.lower() == "a" and attrs:
        out.append(next(iter(attrs.values())))
    for k in kids:
        out += html_expected(k, inside or tag.lower() == "nav")
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(html_trees(), min_size=1, max_size=4))
def test_lenient_scope_equals_container_ancestry(forest):
    from linkgraph.operators.extract import scan_html

    doc = "<html>" + "".join(render(t) for t in forest) + "</html>"
    want = [h for t in forest for h in html_expected(t)]
    assert scan_html(doc, "nav", None, None) == want
