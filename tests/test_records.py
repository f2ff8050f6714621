"""Record split and name predicate."""

from linkgraph.operators.records import split_records


def test_split_first_colon_and_reasons(spark):
    lines = spark.createDataFrame([("a:b:c",), ("nocolon",), (":x",), ("U~v:x",), ("ok:",)], "value string")
    got = {r.line: (r.page, r.html, r.reason) for r in split_records(lines).collect()}
    assert got == {
        "a:b:c": ("a", "b:c", None),
        "nocolon": (None, None, "no_delimiter"),
        ":x": ("", "x", "bad_name"),
        "U~v:x": ("U~v", "x", "bad_name"),
        "ok:": ("ok", "", None),
    }
