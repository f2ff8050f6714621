import glob
import os
import random
import string

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import brute
from linkgraph.llm import quality

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def texts():
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(2, 8))) for _ in range(n))
    noise = lambda n: "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=n))
    return [None, "", " \n\t", "one", prose(49), prose(50), prose(400), prose(6000), (prose(20) + "\n") * 200, "la " * 300,
            " ".join(noise(30) for _ in range(60)), noise(20_000), prose(3000) + " " + " ".join(noise(60) for _ in range(200)),
            "a b c\na b c\n\n \n \nd", "a a a a", "é" * 3000 + " # * $ % & | < >", prose(60) + "\x85" + "　", "x " * 100_000]


def test_equals_brute_force(spark):
    rows = [(i, t, "x", True) for i, t in enumerate(texts())] + [(None, "la la", None, None), (3, "one", "x", True)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, ratio string, kept boolean")).collect()
    assert sorted((repr((r["doc_id"], *(r[n] for n in NAMES))) for r in got)) == sorted(repr((d, *brute.quality(t))) for d, t, _, _ in rows)


def test_wide_bands_reject_noise_and_repetition():
    verdict = [brute.quality(t)[-1] for t in texts()]
    assert verdict[6] and verdict[7]           # prose
    assert not any(verdict[i] for i in (8, 9, 10, 11, 12))  # repeated, random, prose with a random part


def test_fitted_bands_follow_the_labelled_texts(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(2, 8))) for _ in range(n))
    docs = [(i, prose(80 + 20 * (i % 3))) for i in range(60)] + [(i, prose(1500)) for i in range(60, 90)] + [(90, "la " * 400), (91, None), (60, prose(1500))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    label = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, text string")
    labels = [(i, 1, "x") for i in range(92)] + [(5, 1, "x"), (None, 1, "x"), (1000, 1, "x")]
    bands, want = quality.fit_bands(frame, label(labels)), brute.fit_bands(docs, {d: 1 for d in range(92)})
    assert [b[1:] for b in bands.whole] == [pytest.approx(b[1:]) for b in want[0]] and bands.chunk == pytest.approx(want[1])
    assert bands.whole != quality.WIDE.whole
    for few in ([], labels[:19], [(i, 0, "x") for i in range(90)]):
        assert quality.fit_bands(frame, label(few)) == quality.WIDE
    assert quality.fit_bands(frame, label(labels), sample=10) == quality.WIDE


def test_a_fit_reads_every_labelled_text(spark):
    """More clean texts than the 20,000 that a fit once stopped at, in the order in which it took them; the dense kind comes last."""
    rng = random.Random(9)
    kinds = [" ".join("".join(rng.choices("etaoinshr", k=rng.randrange(2, 8))) for _ in range(60)) for _ in range(40)]
    dense = [" ".join(f"w{i % 30}" for i in range(j, j + 60)) + " " + " ".join(f"{j}x{i}" for i in range(60)) for j in range(8)]
    ids = [r["id"] for r in spark.range(21_000).orderBy(F.xxhash64("id"), "id").collect()]
    docs = [(d, dense[i % 8] if i >= 20_000 else kinds[i % 40]) for i, d in enumerate(ids)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = frame.select("doc_id", F.lit(1).alias("quality"))
    bands = quality.fit_bands(frame, labels)
    want = {}
    for _, t in docs:
        if not brute.base_failed(t)[0]:
            size = len(t.encode())
            number = next(i for i, b in enumerate(quality.WIDE.whole) if b[0] is None or size < b[0])
            want.setdefault(number, []).append(brute.ratios(t)[0])
    assert sum(map(len, want.values())) == len(docs)
    for number, found in want.items():
        assert bands.whole[number][1:] == pytest.approx((np.percentile(found, 1) * 0.4, np.percentile(found, 99) * 1.25), rel=1e-12)
    read = []
    quality._fitted, fitted = (lambda rows, *a: read.append(rows.count()) or fitted(rows, *a)), quality._fitted
    try:
        out = quality.judge_fitted(frame, labels)
    finally:
        quality._fitted = fitted
    assert read == [len(docs)] and out.count() == len(docs)


def test_fitted_verdicts_are_those_of_the_bands(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "la la"), (3, "one")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(18)], "doc_id long, quality int")
    want = quality.judge(frame, quality.fit_bands(frame, labels))
    got = quality.judge_fitted(frame, labels)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_keep_good_keeps_rows_as_they_are(spark):
    rows = [(i, t, None, True) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, ratio string, kept boolean")
    out = quality.keep_good(df)
    assert out.schema == df.schema
    assert sorted(tuple(r) for r in out.collect()) == [r for r in rows if brute.quality(r[1])[-1]]
    assert quality.keep_good(df.limit(0)).collect() == [] and quality.judge(df.limit(0)).collect() == []


def sf01(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))


def test_clean_documents_of_the_test_table_are_kept(spark):
    docs, labels = sf01(spark)
    good = labels.where("quality = 1 and toxic = 0").select("doc_id")
    rows = quality.judge(docs.join(good, "doc_id"), quality.fit_bands(docs, labels)).where("not base_failed").collect()
    assert len(rows) > 2000 and all(r["kept"] for r in rows)


def test_narrow_bands_reject_labelled_symbol_junk_from_4_kb_on(spark):
    """What the fit can tell apart on one table, when it is asked to follow it closely."""
    docs, labels = sf01(spark)
    bands = quality.fit_bands(docs, labels, tail=0.0, low_margin=0.02, high_margin=0.1)
    rows = quality.judge(docs.where("octet_length(text) >= 4096"), bands).where("not base_failed").join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert [r for r in rows if r["quality"] == 1 and not r["kept"]] == []
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    assert len(junk) > 50 and sum(junk) <= 0.1 * len(junk)


def test_english_texts_of_other_origin_are_kept(spark):
    """Licences and release notes lie far below the table's prose, where its junk lies; the default margins keep them."""
    docs, labels = sf01(spark)
    bands, pack = quality.fit_bands(docs, labels), zstandard.ZstdCompressor(level=quality.LEVEL)
    found = [p for d in ("/usr/share/common-licenses", "/usr/share/doc") for p in glob.glob(f"{d}/**", recursive=True) if os.path.isfile(p) and not os.path.islink(p)]
    found = {open(p, encoding="utf-8").read() for p in found
             if os.path.basename(p).lower().startswith(("gpl", "lgpl", "apache", "mpl", "gfdl", "artistic", "copyright", "readme"))
             and not p.endswith((".gz", ".html")) and os.path.getsize(p) >= 4096 and _readable(p)}
    rows = [quality.measure(t, pack, bands) for t in found]
    rows = [r[-1] for r in rows if not r[5]]
    assert rows.count(False) <= 0.05 * len(rows) + 1


def _readable(path):
    try:
        open(path, encoding="utf-8").read()
    except (UnicodeDecodeError, OSError):
        return False
    return True


def test_tail_of_a_text_is_judged():
    pack, rng = zstandard.ZstdCompressor(level=quality.LEVEL), random.Random(7)
    prose = " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(2, 8))) for _ in range(9000))
    junk = " ".join("".join(rng.choices(string.ascii_letters + string.digits, k=60)) for _ in range(50))[:1900]
    at = 10 * quality.CHUNK
    whole = quality.WIDE.whole
    bands = quality.Bands(whole, (0.40, 0.60))
    assert quality.measure(prose[:at + 1900], pack, bands)[-1]
    for tail in (junk, "la" * 950):
        assert not quality.measure(prose[:at] + tail, pack, bands)[-1]
