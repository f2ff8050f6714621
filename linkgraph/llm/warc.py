"""WARC archives: written by Spark's text sink, read back by boundary chains.

Writing. A page is a record: its html, in UTF-8, as the payload of an HTTP
response. Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the
one with the smallest ``page_id`` is the response, the others revisit it. A
record's text ends in the blank lines that the format asks for, which are the
sink's line separator, so every part file is an archive.

Reading. Files are read in splits; the separator is the magic ``WARC/1.0``, so
a row is what stands between two magics, and its offset in the file is the sum
of what comes before. Each task parses the rows that look like record heads and
emits, for each split, the chain record -> successor (the offset that the
record's length leads to) and where the split's chains leave it. Chains start
at offset 0 of a file; pointer jumping over the splits' exits finds where each
split is truly entered, in log2(splits of a file) rounds. A second pass reads
the records on the chain; magic inside a payload is never reached. Pieces of a
record that lies in more than one split are put together afterwards.

Cases: a null html is an empty payload; a null url has no target line; a null
``page_id`` is kept, and revisits only a record that has an id; rows that share
the smallest ``page_id`` and the payload are all responses; any character may
occur in url and html, the magic included; an empty table writes no record;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linkgraph.llm.common import batches, saved

MIN_REVISIT = 100
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
#: Table sizes up to which repeated payloads, or split entries, are broadcast.
BROADCAST_ROWS = 100_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing ----------------------------------------------------------------

def _bounded(small: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` marked for broadcast if it has few rows, else left to a shuffled join."""
    return F.broadcast(small) if small.limit(bound + 1).count() <= bound else small


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(record): each page's record, without the blank lines at its end."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha2(F.col("payload").cast("binary"), 256)})
    copies = (rows.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
              .where("n > 1 and first_id is not null").select(F.col("digest").alias("copied"), "first_id"))
    rows = rows.join(_bounded(saved(copies, "warc-copies")), F.col("digest") == F.col("copied"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    id_text = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")  # a url may not break its line
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:x-page:"), id_text, F.lit(f">\r\nWARC-Date: {DATE}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(again, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:x-page:"), F.col("first_id").cast("string"), F.lit(">")))
        .otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    return rows.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """One archive per task under ``path``."""
    records(pages, min_revisit).write.option("lineSep", END).text(path)


# --- reading ----------------------------------------------------------------

_FIELD = re.compile(rb"^(?i:content-length):[ \t]*([0-9]+)[ \t]*\r?$", re.M)
MAGIC_BYTES, END_BYTES = MAGIC.encode(), END.encode()


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, row): what stands between two magics, in file order within a split."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                        F.col("value").cast("binary").alias("row"))


def _length(row: bytes) -> int | None:
    """Bytes from a record's magic to its successor's, if ``row`` begins a record."""
    end = row.find(END_BYTES)
    found = _FIELD.search(row, 0, end) if end >= 0 else None
    return len(MAGIC_BYTES) + end + len(END_BYTES) + int(found[1]) + len(END_BYTES) if found else None


def _by_split(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[tuple]]]:
    """The rows (further columns) of each split of a task, one split after the other."""
    source = (row for part in parts for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), *part.columns[2:]))
    row = next(source, None)

    def rest(file: str, split: int) -> Iterator[tuple]:
        nonlocal row
        while row is not None and row[:2] == (file, split):
            yield tuple(x.as_py() for x in row[2:])
            row = next(source, None)

    while row is not None:
        file, split = row[:2]
        own = rest(file, split)
        yield file, split, own
        for _ in own:
            pass


def chains(rows: DataFrame) -> DataFrame:
    """(file, split, size, heads, ends) per split.

    A record's offset is that of its first byte after the magic, counted from
    the split's first row. ``heads``: offsets of candidate records, ``ends``:
    where the chain from each leaves the split. ``size``: bytes of all rows.
    """
    longs = pa.list_(pa.int64())
    schema = pa.schema([("file", pa.string()), ("split", pa.int64()), ("size", pa.int64()), ("heads", longs), ("ends", longs)])

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for file, split, own in _by_split(parts):
            at, after = 0, {}
            for i, (row,) in enumerate(own):
                length = _length(row) if split or i else None  # what precedes a file's first magic is no record
                if length:
                    after[at] = at + length
                at += len(row) + len(MAGIC_BYTES)
            # Successors lie ahead: from the back, a chain's end is its successor's.
            end: dict[int, int] = {}
            for head in reversed(after):
                end[head] = end.get(after[head], after[head])
            yield file, split, at, list(reversed(end)), list(reversed(end.values()))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(scan(parts), schema, 64)

    return saved(rows.mapInArrow(run, "file string, split long, size long, heads array<long>, ends array<long>"), "warc-chains")


def entries(chained: DataFrame) -> DataFrame:
    """(file, split, base, entry, until) per split.

    ``base``: offset of the split's first row in its file. ``entry``: offset in
    the split at which the chain from the file's start enters it, null if it
    does not. ``until``: offset in the file at which the chain is next met, here
    or in a later split; what stands before it belongs to an earlier record.
    """
    splits = Window.partitionBy("file").orderBy("split")
    based = saved(chained.withColumn("base", F.sum("size").over(splits) - F.col("size")), "warc-bases")
    heads = based.select("file", "split", "base", F.explode(F.arrays_zip("heads", "ends")).alias("h")).select(
        "file", "split", "base", (F.col("base") + F.col("h.heads")).alias("at"), (F.col("base") + F.col("h.ends")).alias("next"))
    # A split may be entered at the start of the file, or where another split's chain ends.
    start = F.col("at") == len(MAGIC_BYTES)
    ends = heads.select("file", F.col("next").alias("at")).distinct()
    gates = saved(heads.where(start).unionByName(heads.where(~start).join(ends, ["file", "at"], "left_semi")), "warc-gates")
    # Pointer jumping: what is reached in 2^i jumps, and the jump of that length.
    jump, reached = gates.select("file", "at", "next"), gates.where(start).select("file", "at")
    most = gates.groupBy("file").agg(F.countDistinct("split").alias("n")).agg(F.max("n")).first()[0] or 1
    for _ in range((most - 1).bit_length()):
        onward = reached.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = saved(reached.unionByName(onward).distinct(), "warc-reached")
        further = jump.select("file", F.col("at").alias("next"), F.col("next").alias("to"))
        jump = saved(jump.join(further, ["file", "next"]).select("file", "at", F.col("to").alias("next")), "warc-jumps")
    on_chain = gates.join(reached, ["file", "at"], "left_semi").groupBy("file", "split").agg(F.min("at").alias("entered"))
    known = based.select("file", "split", "base", "size").join(on_chain, ["file", "split"], "left")
    ahead = F.first("entered", ignorenulls=True).over(splits.rowsBetween(0, Window.unboundedFollowing))
    total = F.max(F.col("base") + F.col("size")).over(Window.partitionBy("file"))
    return known.select("file", "split", "base", (F.col("entered") - F.col("base")).alias("entry"), F.coalesce(ahead, total).alias("until"))


_RECORD_ID = re.compile(rb"^(?i:warc-record-id):[ \t]*<urn:x-page:(-?[0-9]+|null)>", re.M)
_REFERS_TO = re.compile(rb"^(?i:warc-refers-to):[ \t]*<urn:x-page:(-?[0-9]+)>", re.M)
_TYPE = re.compile(rb"^(?i:warc-type):[ \t]*([a-z]+)", re.M)
_DIGEST = re.compile(rb"^(?i:warc-payload-digest):[ \t]*sha256:([0-9a-f]+)", re.M)


def parsed(record: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of a record after its magic."""
    end = record.index(END_BYTES)
    head, block = record[:end], record[end + len(END_BYTES):-len(END_BYTES)]
    http_end = block.index(END_BYTES)
    payload, kind = block[http_end + len(END_BYTES):], _TYPE.search(head)[1].decode()
    page = _RECORD_ID.search(head)[1]
    refers = _REFERS_TO.search(head)
    if kind == "revisit":  # length and digest of the payload it stands for
        size, digest, payload = int(_FIELD.search(block, 0, http_end)[1]), _DIGEST.search(head)[1].decode(), None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    return None if page == b"null" else int(page), size, digest, kind, int(refers[1]) if refers else None, payload


def of_records(loose: DataFrame) -> DataFrame:
    """The pieces (file, until, row) of records whose head tells where they end.

    After a break in a chain no record begins, and all rows up to the end of the
    file share one ``until``, which no head names: they go before anything is
    gathered. A group that stays is no larger than its own head says.
    """
    heads = loose.where("row.head").select("file", "until").distinct()
    return loose.join(heads, ["file", "until"], "left_semi")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload)
    of the records reached from the start of each file under ``path``.

    Length and digest of a response come from its payload as read. Without
    ``payloads``, that column is null.
    """
    rows = _rows(spark, path)
    entered = saved(entries(chains(rows)), "warc-entries")
    # Most splits are entered at their first candidate; only the others need to be told.
    usual = F.when(F.col("split") == 0, F.lit(len(MAGIC_BYTES))).otherwise(F.lit(0)).cast("long")
    odd = saved(entered.where(~F.col("entry").eqNullSafe(usual)).select("file", "split", F.coalesce("entry", F.lit(-1)).alias("entry")), "warc-odd")
    if odd.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        told = rows.join(F.broadcast(odd), ["file", "split"], "left")
    else:
        numbered = rows.withColumn("n", F.monotonically_increasing_id())
        told = numbered.join(odd, ["file", "split"], "left").repartition("file", "split").sortWithinPartitions("file", "split", "n")
    told = told.select("file", "split", "row", F.coalesce("entry", usual).alias("entry"))
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
              ("refers_to", pa.int64()), ("payload", pa.binary())]
    names = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    pieces = [("file", pa.string()), ("split", pa.int64()), ("at", pa.int64()), ("next", pa.int64()), ("piece", pa.binary())]
    both, whole = pa.schema(pieces + fields), pa.schema(fields)

    def out(record: bytes) -> tuple:
        values = parsed(record)
        return values if payloads else (*values[:-1], None)

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Records that end in their split, and the rows (pieces) of those that do not."""
        for file, split, own in _by_split(parts):
            at, inside, held, begin, end = 0, False, [], 0, 0
            for row, entry in own:
                inside = inside or at == entry
                if not inside:
                    yield file, split, at, None, row, *none
                else:
                    if not held:
                        length = _length(row)
                        if length is None:
                            break  # the chain ends: what follows is no record
                        begin, end = at, at + length
                    held.append(row)
                    if at + len(row) + len(MAGIC_BYTES) > end:
                        held = []
                        break  # a length that leads to no record
                at += len(row) + len(MAGIC_BYTES)
                if held and at == end:
                    yield *(None,) * len(pieces), *out(MAGIC_BYTES.join(held))
                    held = []
            for row in held:
                yield file, split, begin, end, row, *none
                begin += len(row) + len(MAGIC_BYTES)

    def joined(part: pa.RecordBatch) -> Iterator[tuple]:
        """Records put together from the pieces of several splits."""
        for until, rows_of in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            size = sum(len(r["piece"]) + len(MAGIC_BYTES) for r in rows_of)
            if rows_of[0]["head"] and rows_of[0]["at"] + size == until:
                yield out(MAGIC_BYTES.join(r["piece"] for r in rows_of))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(read(parts), both, 500)

    def run_joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield from batches(joined(part), whole, 500)

    none = (None,) * len(fields)
    found = saved(told.mapInArrow(run, "file string, split long, at long, next long, piece binary, " + names), "warc-records")
    loose = found.where("piece is not null").join(entered.drop("entry"), ["file", "split"]).select(
        "file", F.coalesce(F.col("base") + F.col("next"), F.col("until")).alias("until"),
        F.struct((F.col("base") + F.col("at")).alias("at"), F.col("next").isNotNull().alias("head"), "piece").alias("row"))
    groups = of_records(loose).groupBy("file", "until").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    spread = groups.select("until", "rows").mapInArrow(run_joined, names)
    columns = [n for n, _ in fields]
    return found.where("record_type is not null").select(*columns).unionByName(spread)
