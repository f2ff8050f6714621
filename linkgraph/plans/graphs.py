"""Test graphs derived from the driver's tables (``/root/testdata/sf*/``).

* ``trade``: orders ⋈ lineitem on the order key; customer → supplier for
  non-returned lines, supplier → customer for returned ones, supplier → part
  for every line item. Repeats kept. Ids are prefixed ``C``/``S``/``P``.
* ``wiki_lines``: one strict-mode dump line per row of ``pages``, with all of
  its html, built so that every ingest outcome and container rule occurs.
* ``page_nav``: the raw ``pages`` as a page table for lenient mode,
  names ``p<page_id>``, links ``href="/X"`` inside ``<nav>``.

Everything is a DataFrame expression over the parquet scans: the graphs grow
with the tables, and column pruning reaches the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import Graph


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)`` of the trade graph, one row per link.

    One join of line items with orders gives the customer/supplier link of each
    line, its direction chosen per row by the return flag; supplier → part
    links need no join. Line items are read twice but shuffled once.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    supp = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    part = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    returned = F.col("l_returnflag") == "R"
    trades = (li.where(F.col("l_returnflag").isNotNull())
              .select("l_orderkey", "l_suppkey", "l_returnflag")
              .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    customer_supplier = trades.select(F.when(returned, supp).otherwise(cust).alias("src"),
                                      F.when(returned, cust).otherwise(supp).alias("dst"))
    supplies = li.select(supp.alias("src"), part.alias("dst"))
    return customer_supplier.unionByName(supplies)


def trade_graph(spark: SparkSession, sf_dir: str) -> Graph:
    return Graph(edges=trade_edges(spark, sf_dir))


# The recipe of ``wiki_lines``, keyed by page_id (FIXTURES.md §4). Containers
# cycle every three pages, so that they meet every name, delimiter and defect.
CONTAINERS = [
    '<div id="bodyContent">', '<DIV id="BODYCONTENT">', '<div ID="bodyContent">',
    '<div id="bodyContent"><div id="bodyContent"><a href="../articles/in.html">i</a></div>',
    '<div id="bodyContent"><a href="../articles/first.html"/></div><p><a href="../articles/between.html">b</a></p><div id="bodyContent">',
    '<div id="bodyContent"><A href="../articles/up.html">u</A><a>none</a><a HREF="../articles/no.html">n</a>',
    '<div id="bodyContent">', '<div id="other">']
DOCTYPE_AT = 6
DEFECTS = ["<br>", "<b><i>x</b></i>", '<p x="1" x="2"></p>']


def _pick(key: F.Column, options: list[str]) -> F.Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (key + 1).cast("int"))


def xml_body(html: F.Column) -> F.Column:
    """A page's whole html as well-formed content: its anchors ``<a href="/X">``
    become ``<a href="../articles/X.html">``, all other markup becomes text."""
    marked = F.regexp_replace(html, r'<a href="/([^"<>]*)">([^<]*)</a>', "\uE000$1\uE001$2\uE002")
    for a, b in (("<", "&lt;"), ("]]>", "]]&gt;"), ("\uE000", '<a href="../articles/'), ("\uE001", '.html">'), ("\uE002", "</a>"), ("\n", " ")):
        marked = F.replace(marked, F.lit(a), F.lit(b))
    return marked


def wiki_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value)``: strict-mode lines, one per page, each with the page's whole
    html in its container (recipe in FIXTURES.md §4)."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    pid = F.col("page_id")
    name = F.concat(F.when(pid % 10 == 9, F.lit("User~")).otherwise(F.lit("")), F.lit("p"),
                    F.when(pid % 15 == 13, pid - 1).otherwise(pid).cast("string"))
    third = F.floor(pid / 3) % len(CONTAINERS)
    doctype = F.when(third == DOCTYPE_AT, F.lit('<!DOCTYPE html SYSTEM "http://nowhere.invalid/x.dtd">')).otherwise(F.lit(""))
    own = F.concat(F.lit('<a href="../articles/p'), ((pid * 7 + 1) % 50).cast("string"), F.lit('.html">n</a>'))
    defect = F.when(pid % 7 == 6, _pick(F.floor(pid / 7) % len(DEFECTS), DEFECTS)).otherwise(F.lit(""))
    close = F.when(third == 1, F.lit("</DIV>")).otherwise(F.lit("</div>"))
    rest = F.concat(doctype, F.lit("<html><body>"), _pick(third, CONTAINERS), xml_body(F.col("html")), own, defect, close,
                    F.lit('<a href="./p0.html">out</a></body></html>'))
    # Some lines have no delimiter at all.
    line = F.when(pid % 25 == 24, F.replace(F.concat(name, rest), F.lit(":"), F.lit(" "))).otherwise(F.concat(name, F.lit(":"), rest))
    return p.select(line.alias("value"))


def page_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page, html)``: the raw pages, named ``p<page_id>``."""
    p = table(spark, sf_dir, "pages")
    return p.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("page"), "html")
