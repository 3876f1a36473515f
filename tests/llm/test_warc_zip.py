"""Round trip through archives; foreign ZIP and ZIP64 files."""
import hashlib
import io
import zipfile

import pytest

from txwatch.llm import warc_zip as W

SCHEMA = "page_id long, url string, html string, payload string, digest int"
LONG = "<p>" + "é" * 200


def test_round_trip_with_edges(spark, tmp_path):
    rows = [(5, "http://a/ü\r\nX: y", LONG), (3, "http://b", LONG), (9, None, LONG), (3, "http://b", LONG), (1, "u", "short"),
            (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "x" * 100), (8, "u", "x" * 100), (10, "u", "y" * 99),
            (11, "u", "y" * 99), (None, "u", "z"), (12, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (13, "", "big " * 10 ** 6)]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA).repartition(3)
    got = W.round_trip(df, folder=f"file://{tmp_path}/out", archive_bytes=200).collect()
    assert len(got) == len(rows)
    html = {r[0]: r[2] or "" for r in rows}
    for r in got:
        body = html[r.page_id].encode()
        assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha256(body).hexdigest()
        refers = {5: 3, 9: 3, 8: 7}.get(r.page_id)
        assert r.refers_to == refers and r.record_type == ("revisit" if refers else "response")
        assert (bytes(r.payload) == body) if not refers else r.payload is None
    listed = W.list_archives(spark, f"file://{tmp_path}/out")
    assert listed.count() > 1 and W.read_archives(listed).count() == len(rows)
    assert W.round_trip(df.limit(0)).count() == 0


def _zip(comment=b"", method=zipfile.ZIP_STORED, wide=False, monkeypatch=None):
    if wide:  # every size and offset goes to the ZIP64 fields
        for name in ("ZIP64_LIMIT", "ZIP_FILECOUNT_LIMIT"):
            monkeypatch.setattr(zipfile, name, 0)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        z.comment = comment
        for i in range(3):
            with z.open(f"d/é{i}", "w", force_zip64=wide) as f:
                f.write(b"%d" % i * 50)
    return out


@pytest.mark.parametrize("wide", [False, True])
def test_directories(wide, monkeypatch):
    out = _zip(b"a comment with PK\x05\x06 inside" if not wide else b"", wide=wide, monkeypatch=monkeypatch)
    raw = out.getvalue()
    if wide:
        assert b"PK\x06\x07" in raw and b"PK\x06\x06" in raw
    members = W.directory(out, len(raw))
    assert [m.name for m in members] == [f"d/é{i}" for i in range(3)]
    for i, m in enumerate(members):
        at = W.begin(out, m)
        assert raw[at:at + m.size] == b"%d" % i * 50 and m.size == m.packed == 50


def test_bad_archives():
    for raw in (b"", b"no archive", _zip().getvalue()[:-5]):
        with pytest.raises(W.BadArchive):
            W.directory(io.BytesIO(raw), len(raw))
    out = _zip(method=zipfile.ZIP_DEFLATED)
    members = W.directory(out, len(out.getvalue()))
    with pytest.raises(W.BadArchive):
        W.begin(out, members[0])
