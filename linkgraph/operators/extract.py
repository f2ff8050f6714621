"""Link extraction from page bodies.

The one step Spark's built-in functions cannot express: deciding whether a page
is well-formed XML and collecting the ``href`` of anchors inside one container
element, tracking element depth. It runs as an Arrow-batched ``mapInArrow``
job, one page at a time inside each batch, next to the scan: no shuffle.
Only the raw ``href`` values leave Python; decoding (P10) and the target
pattern (P11) run JVM-side on the exploded rows.

Two modes:

* ``strict``: the page must parse as XML (stdlib expat, no DTD loading); any
  error drops the whole page. ``&`` is first rewritten to ``@amp;`` (P3), in
  Spark, before the page reaches Python. The container is entered at depth 0
  only; every start tag inside adds one level, every end tag removes one.
* ``lenient``: real web HTML, read in one forward pass that accepts any text
  and takes time linear in its length (entities in attributes decoded). Depth
  counts the container tag only, as pages leave other tags open.
"""

from __future__ import annotations

import html
import html.entities
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import CONTAINER, LINK_TARGET_PATTERN, decode_href, link_target, neutralise_entities
from .records import ILL_FORMED, OK

# Characters of a page that the strict parser is fed at a time.
PIECE = 1 << 18

EXTRACTED_SCHEMA = "page string, reason string, hrefs array<string>, line string"


def _fold_char(c: str, upper: bool) -> str:
    # Per-character case mapping: a mapping that yields several characters
    # (e.g. 'ß' → 'SS') leaves the character unchanged.
    m = c.upper() if upper else c.lower()
    return m if len(m) == 1 else c


def equals_ignore_case(a: str | None, b: str) -> bool:
    """Character-wise case-insensitive equality (upper, then lower, per pair)."""
    if a is None or len(a) != len(b):
        return False
    for x, y in zip(a, b):
        if x == y:
            continue
        ux, uy = _fold_char(x, True), _fold_char(y, True)
        if ux == uy or _fold_char(ux, False) == _fold_char(uy, False):
            continue
        return False
    return True


def scan_xml(doc: str | None, tag: str, attr: str | None, value: str | None):
    """Strict mode for one page: ``None`` if not well-formed, else the list of
    raw ``href`` values of anchors inside the container, in document order."""
    from xml.parsers import expat

    if doc is None:
        return None
    links: list[str] = []
    depth = 0
    n_tag = len(tag)

    def same(name: str, want: str) -> bool:
        # Fast paths for the usual ASCII names; the full rule otherwise.
        if name.isascii():
            return name.lower() == want.lower()
        return equals_ignore_case(name, want)

    def start(name, attrs):
        nonlocal depth
        if depth == 0:
            if (len(name) == n_tag and same(name, tag)
                    and (attr is None or equals_ignore_case(attrs.get(attr), value))):
                depth = 1
        else:
            depth += 1
            if len(name) == 1 and same(name, "a"):
                href = attrs.get("href")
                if href is not None:
                    links.append(href)

    def end(name):
        nonlocal depth
        if depth > 0:
            depth -= 1

    # The page is a character string, so any encoding it declares is moot:
    # hand expat UTF-8 bytes and say so.
    parser = expat.ParserCreate(encoding="UTF-8")
    parser.StartElementHandler = start
    parser.EndElementHandler = end
    try:
        # Piece by piece, so that a very long page is never held encoded as a whole.
        for at in range(0, len(doc), PIECE):
            parser.Parse(doc[at:at + PIECE].encode("utf-8", "surrogatepass"), False)
        parser.Parse(b"", True)
    except (expat.ExpatError, ValueError):
        return None
    return links


_ATTRIBUTE = r"""[ \t\n\f\r/]*+([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:"([^"]*+)"|'([^']*+)'|([^ \t\n\f\r"'>][^ \t\n\f\r>]*+)|(?=>)))?+"""
_TAG_NAME = r"<([a-zA-Z][^ \t\n\f\r/>]*+)"
# A whole start tag. Every loop is possessive: a tag is tried once, left to right.
_START_TAG = re.compile(_TAG_NAME + "((?:" + re.sub(r"\((?!\?)", "(?:", _ATTRIBUTE) + r")*+)[ \t\n\f\r/]*+>")
_ATTRIBUTES, _NAME = re.compile(_ATTRIBUTE), re.compile(_TAG_NAME)
# A '<' that can begin a tag or a section; any other is text.
_OPENING = re.compile(r"<(?=[a-zA-Z/!?])")
_END_NAME = re.compile(r"</([a-zA-Z][^ \t\n\f\r/>]*+)")
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*+[;=]?)")
# Elements whose content is text up to their own end tag.
_TEXT_ELEMENTS = {name: re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.IGNORECASE | re.ASCII)
                  for name in ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")}


def _decoded(value: str) -> str:
    """An attribute value with its character references replaced. A name without
    a semicolon counts only if it is known as such and no ``=`` or letter follows."""
    def one(m: re.Match) -> str:
        ref = m[0]
        if ref[1] == "#" or ref[-1] == ";":
            return html.unescape(ref)
        return html.unescape(ref) if ref[-1] != "=" and ref[1:] in html.entities.html5 else ref

    return _REFERENCE.sub(one, value) if "&" in value else value


def _attribute(text: str, key: str) -> str | None:
    """The first attribute named ``key`` in the attributes of a start tag."""
    for m in _ATTRIBUTES.finditer(text):
        if m[1].lower() == key:
            value = next((v for v in m.groups()[1:] if v is not None), None)
            return None if value is None else _decoded(value)
    return None


def scan_html(doc: str | None, tag: str, attr: str | None, value: str | None):
    """Lenient mode for one page: raw ``href`` values of anchors inside the
    container (entities decoded); depth follows the container tag only.

    Any text is accepted. Comments run to ``-->``, or to the next ``>`` if there
    is none; other ``<!`` and ``<?`` sections run to the next ``>``. A quote that
    hides the end of a tag hides it from the whole rest of the page: from there
    on, tags end at the next ``>``, whatever is quoted. Every step goes forward:
    the next ``>`` is kept until it has been passed, and a search that fails is
    not repeated, so the time is linear.
    """
    if doc is None:
        return None
    tag_l = tag.lower()
    attr_l = attr.lower() if attr else None
    depth, pos, links = 0, 0, []
    comments, quotes, gt = True, True, -1
    while opening := _OPENING.search(doc, pos):
        lt = opening.start()
        if gt < lt and (gt := doc.find(">", lt)) < 0:
            break                                   # no later tag has an end
        kind = doc[lt + 1]
        if kind in "!?":
            pos = gt + 1
            if comments and doc.startswith("<!--", lt) and not doc.startswith((">", "->"), lt + 4):
                close = doc.find("-->", lt + 4)
                comments = close >= 0
                pos = close + 3 if comments else pos
        elif kind == "/":
            name = _END_NAME.match(doc, lt)
            pos = gt + 1
            if name and name[1].lower() == tag_l and depth > 0:
                depth -= 1
        else:
            name = _NAME.match(doc, lt)
            whole = _START_TAG.match(doc, lt) if quotes else None
            quotes = quotes and whole is not None
            pos = whole.end() if whole else gt + 1
            found = name[1].lower()
            if found == tag_l or found == "a" and depth > 0:
                attrs = whole[2] if whole else doc[name.end():gt] + " "
                if found == tag_l:
                    if depth > 0:
                        depth += 1
                    elif attr_l is None or equals_ignore_case(_attribute(attrs, attr_l), value):
                        depth = 1
                elif (href := _attribute(attrs, "href")) is not None:
                    links.append(href)
            elif found in _TEXT_ELEMENTS:
                end = _TEXT_ELEMENTS[found].search(doc, pos)
                if end is None:
                    break                           # the rest of the page is its text
                pos = end.start()
    return links


def _scan_batches(batches, mode: str, tag: str, attr: str | None, value: str | None):
    import pyarrow.compute as pc

    scan = scan_xml if mode == "strict" else scan_html
    for batch in batches:
        names = batch.schema.names
        docs = batch.column(names.index("html")).to_pylist()
        given = (batch.column(names.index("reason")).to_pylist()
                 if "reason" in names else [None] * len(docs))
        reasons, hrefs = [], []
        for doc, why in zip(docs, given):
            found = None if why is not None else scan(doc, tag, attr, value)
            reasons.append(why if why is not None else (OK if found is not None else ILL_FORMED))
            hrefs.append(found if found is not None else [])
        reason = pa.array(reasons, pa.string())
        if "line" in names:
            # Keep the raw line for rejects only.
            line = pc.if_else(pc.equal(reason, OK), pa.scalar(None, pa.string()),
                              batch.column(names.index("line")))
        else:
            line = pa.nulls(len(docs), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(names.index("page")), reason,
             pa.array(hrefs, pa.list_(pa.string())), line],
            names=["page", "reason", "hrefs", "line"])


# Ship this module's code with the job itself, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def extract_links(records: DataFrame, mode: str = "strict",
                  container: tuple[str, str | None, str | None] = CONTAINER) -> DataFrame:
    """``(page, html[, reason][, line])`` → ``(page, reason, hrefs, line)``.

    ``reason`` is ``ok``, ``ill_formed``, or the reason already given on input
    (such rows are passed through without parsing, and their html is never
    sent to Python). ``hrefs`` holds the raw in-scope anchors of ``ok`` pages.
    ``line`` is kept for rejected rows only. Strict mode neutralises entities
    (P3) JVM-side first. ``container`` is ``(tag, attribute, value)``;
    attribute ``None`` means any element of that tag.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"mode must be 'strict' or 'lenient', not {mode!r}")
    tag, attr, value = container
    body = neutralise_entities("html") if mode == "strict" else F.col("html")
    reason = F.col("reason") if "reason" in records.columns else F.lit(None).cast("string")
    if mode == "lenient":
        # A start tag is '<' right before its name, so a page without that text
        # has no container and no links; lenient mode rejects nothing, so it is
        # accepted here without a trip through Python.
        no_container = ~F.col("html").rlike("(?i)<" + re.escape(tag))
        reason = F.coalesce(reason, F.when(F.col("html").isNotNull() & no_container, F.lit(OK)))
    cols = [F.col("page").cast("string").alias("page"), reason.alias("reason"),
            F.when(reason.isNull(), body).alias("html")]
    if "line" in records.columns:
        cols.append(F.col("line"))
    return records.select(*cols).mapInArrow(
        lambda it: _scan_batches(it, mode, tag, attr, value), EXTRACTED_SCHEMA)


def link_rows(extracted: DataFrame, pattern: str = LINK_TARGET_PATTERN,
              decode: bool = True) -> DataFrame:
    """Accepted pages' hrefs → ``(page, pos, href, target)`` for matching links.

    ``pos`` is the href's 0-based place among the page's in-scope anchors.
    Decoding comes before matching (P10 then P11), both JVM-side.
    """
    rows = (extracted.where(F.col("reason") == OK)
            .select("page", F.posexplode("hrefs").alias("pos", "href")))
    link = decode_href("href") if decode else F.col("href")
    return (rows.select("page", F.col("pos").cast("bigint").alias("pos"), "href",
                        link_target(link, pattern).alias("target"))
            .where(F.col("target").isNotNull()))
