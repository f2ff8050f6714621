import glob

import pytest

import brute
from linkgraph.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, record string"


def expected(rows, least=100):
    out = []
    for page, _, html in rows:
        size, digest = len((html or "").encode()), brute.sha(html or "")
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        again = size >= least and first is not None and page != first
        out.append((page, size, digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def back(spark, path):
    rows = warc.read_archives(spark, path).collect()
    return sorted((tuple(r)[:5] for r in rows), key=repr), {r["page_id"]: r["payload"] for r in rows}


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", size)
    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def record(page, payload):
    http = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n"
    return (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{page}>\r\nContent-Length: {len(http) + len(payload)}\r\n\r\n"
            f"{http}{payload}\r\n\r\n")


PAGES = [(1, "http://a/", "x" * 150), (2, "http://b/\r\nWARC/1.0\r\nInjected: 1", "x" * 150), (3, None, None), (4, "", ""), (5, "u", "x" * 99),
         (6, "u", "x" * 99), (7, "é", "é" * 50), (8, "u", "é" * 50), (None, "u", "x" * 150), (10, "u", "WARC/1.0\r\n" * 30),
         (11, "u", record(12, "inner " + record(13, "innermost") + "WARC/1.0\r\n\r\n") * 3 + "tail\r\n\r\n"), (14, "u", "\r\n\r\nWARC/1.0\r\n"),
         (15, "u", record(99, "y" * 500)), (16, "u", record(99, "y" * 500)), (17, "u", "\x00\x01 \u2028 𝕏" * 40), (-3, "u", "z" * 200)]


@pytest.mark.parametrize("size", [None, 150, 1000])
def test_round_trip(spark, tmp_path, small_splits, size):
    path = str(tmp_path / "w")
    warc.write_archives(frame(spark, PAGES).coalesce(2), path)
    if size:
        small_splits(size)
    rows, payloads = back(spark, path)
    assert rows == expected(PAGES)
    assert payloads[11].decode() == PAGES[10][2] and payloads[16] is None


def test_many_records_over_many_splits(spark, tmp_path, small_splits):
    pages = [(i, "u", (record(1000 + i, "q" * (i % 50)) if i % 7 == 0 else f"page {i} ") * (i % 9)) for i in range(120)]
    path = str(tmp_path / "w")
    warc.write_archives(frame(spark, pages).coalesce(1), path)
    small_splits(900)
    assert back(spark, path)[0] == expected(pages)


def test_archives_have_the_format(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(frame(spark, PAGES[:2]).coalesce(1), path)
    (file,) = glob.glob(f"{path}/part-*")
    raw = open(file, "rb").read()
    assert raw.startswith(b"WARC/1.0\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n") and raw.count(b"WARC-Refers-To: <urn:x-page:1>\r\n") == 1
    assert b"\r\nInjected" not in raw


@pytest.mark.parametrize("junk,left", [(b"junk", []), (b"WARC/1.0\r\nno length\r\n\r\n", [])])
def test_what_no_chain_reaches_is_no_record(spark, tmp_path, junk, left):
    (tmp_path / "a.warc").write_bytes(junk + record(1, "a").encode())
    (tmp_path / "b.warc").write_bytes(record(2, "b").encode() + b"WARC/1.0\r\nbroken\r\n\r\n" + record(3, "c").encode())
    (tmp_path / "c.warc").write_bytes(record(4, "d").encode() + record(5, "e" * 100).encode()[:-50])
    assert [r[0] for r in back(spark, str(tmp_path))[0]] == [*left, 2, 4]


@pytest.mark.parametrize("damage", ["longer", "shorter", "cut", "no length"])
def test_a_break_gathers_nothing_that_follows(spark, tmp_path, small_splits, monkeypatch, damage):
    """A large archive broken in its second split: the records before the break, and no group beyond one record."""
    records = [record(i, f"page {i} " * 60) for i in range(120)]
    head, _, rest = records[2].partition("Content-Length: ")
    size, _, tail = rest.partition("\r\n")
    records[2] = {"longer": f"{head}Content-Length: {int(size) + 7}\r\n{tail}", "shorter": f"{head}Content-Length: {int(size) - 7}\r\n{tail}",
                  "cut": records[2][:-40], "no length": f"{head}Length: {size}\r\n{tail}"}[damage]
    path = tmp_path / "w"
    path.mkdir()
    (path / "a.warc").write_bytes("".join(records).encode())
    (path / "b.warc").write_bytes("".join(record(1000 + i, record(99, "b" * 600) * 3) for i in range(30)).encode())
    small_splits(1400)
    seen, of_records = [], warc.of_records
    monkeypatch.setattr(warc, "of_records", lambda loose: seen.append((loose, of_records(loose))) or seen[-1][1])
    rows, _ = back(spark, str(path))
    assert sorted(r[0] for r in rows) == [0, 1, *range(1000, 1030)]
    loose, kept = seen[0]
    size_of = lambda df: [(r["file"][-6:], r["n"]) for r in df.selectExpr("file", "until", "length(row.piece) + 8 AS n").groupBy("file", "until").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()]
    assert max(n for f, n in size_of(loose) if f == "a.warc") > 40_000        # what one task would have gathered
    assert max((n for f, n in size_of(kept) if f == "a.warc"), default=0) <= 2000
    assert 0 < max(n for f, n in size_of(kept) if f == "b.warc") <= 3000


def test_repeated_rows_and_empty(spark, tmp_path):
    rows = [(1, "u", "x" * 150), (1, "v", "x" * 150), (2, "u", "x" * 150)]
    warc.write_archives(frame(spark, rows), str(tmp_path / "w"))
    assert back(spark, str(tmp_path / "w"))[0] == expected(rows)
    warc.write_archives(frame(spark, []), str(tmp_path / "none"))
    assert back(spark, str(tmp_path / "none"))[0] == []
