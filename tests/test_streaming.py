"""The streamed ingest equals the batch ingest of the same lines."""

import tempfile

from wiki14 import WIKI14

from linkgraph.streaming import ingested_from, start_ingest


def test_stream_matches_batch(spark, wiki14):
    src = tempfile.mkdtemp(prefix="lg-stream-src-")
    out = tempfile.mkdtemp(prefix="lg-stream-out-")
    half = len(WIKI14) // 2
    for i, chunk in enumerate([WIKI14[:half], WIKI14[half:]]):
        with open(f"{src}/dump-{i}.txt", "w") as f:
            f.write("\n".join(chunk) + "\n")
    q = start_ingest(spark, src, f"{out}/table", checkpoint_location=f"{out}/ck")
    q.awaitTermination(120)
    streamed = ingested_from(spark, f"{out}/table")
    assert dict(streamed.report().collect()) == dict(wiki14.report().collect())
    assert sorted(map(tuple, streamed.links.collect())) == sorted(map(tuple, wiki14.links.collect()))


def test_each_file_is_ingested_once_across_runs(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "table")
    src.mkdir()
    half, counts = len(WIKI14) // 2, []
    for i, chunk in enumerate([WIKI14[:half], WIKI14[half:], None]):
        if chunk:
            (src / f"dump-{i}.txt").write_text("\n".join(chunk) + "\n")
        start_ingest(spark, str(src), out).awaitTermination(120)
        counts.append(spark.read.parquet(out).count())
    assert counts == [half, 14, 14]
