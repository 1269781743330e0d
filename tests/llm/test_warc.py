"""WARC bundles."""

import hashlib
import os
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from lokum.llm import warc

BIG = "<p>ü</p>" * 100
ROWS = [(3, "http://a/\r\nX: y", BIG), (1, None, BIG), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "", ""),
        (None, "u", BIG), (7, "é", "x" * 3_000_000), (3, "http://a/", BIG), (None, "n", "only null ids " * 20),
        (None, "n", "only null ids " * 20), (8, "h", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9)]


def frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("uid", "digest", "bytes", "first", "path"):
        df = df.withColumn(c, F.lit("extra"))
    return df


def expect(rows):
    out = []
    for k, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same) if same and len(body) >= 100 else k
        out.append((k, len(body), hashlib.sha256(body).hexdigest(), "response" if k == first else "revisit",
                    None if k == first else first))
    return out


def test_round_trip(spark):
    got = [tuple(r) for r in warc.archive(frame(spark).repartition(3)).collect()]
    assert Counter(got) == Counter(expect(ROWS))


def test_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    folder = tmp_path.as_uri()
    index = warc.write_bundles(frame(spark).coalesce(2), folder)
    entries = index.collect()
    assert len(entries) == len(ROWS)
    names = os.listdir(tmp_path)
    assert len([n for n in names if n.endswith(".warc.zst") and not n.startswith(".")]) == 2
    for e in entries:  # every record by its own frame
        head, payload = warc.read_record(folder, e.path, e.frame, e.offset)
        assert head["WARC-Record-ID"] == e.record_id
        if head["WARC-Type"] == "response":
            assert "sha256:" + hashlib.sha256(payload).hexdigest() == head["WARC-Payload-Digest"]
        else:
            assert payload == b"" and "WARC-Refers-To" in head
    for path in {e.path for e in entries}:  # a plain decompressor reads the whole file
        with open(path, "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert sum(1 for _ in warc.records(whole)) == sum(e.path == path for e in entries)


@pytest.mark.parametrize("rows", [[], [(1, "u", None)]])
def test_small(spark, rows):
    assert [tuple(r) for r in warc.archive(frame(spark, rows)).collect()] == expect(rows)


def test_hot_payload(spark):
    rows = [(i, "u", BIG) for i in range(400, 0, -1)] + [(1000 + i, "u", f"{i} {BIG}") for i in range(400)]
    got = [tuple(r) for r in warc.archive(frame(spark, rows).repartition(5)).collect()]
    assert Counter(got) == Counter(expect(rows))
