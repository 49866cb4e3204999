import base64
import gzip
import hashlib
import io
import zipfile

import pytest
from tidemark.llm import warc as W
from tidemark.llm._shared import scratch


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        to = first.get(html or "") if len(raw) >= least and i is not None and first[html or ""] != i else None
        out.append(("" if i is None else str(i), len(raw), digest(raw), "response" if to is None else "revisit", None if to is None else str(to), raw if to is None else None))
    return sorted(out, key=str)


def run(spark, df, **options):
    folder = scratch(spark, "warc")
    got = W.read_packages(W.write_packages(df, folder, **options), folder).collect()
    return sorted(((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got), key=str)


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert run(spark, pages.repartition(3)) == expected([tuple(r) for r in pages.collect()])


@pytest.mark.parametrize("least", [0, 3])
def test_revisits_and_edges(spark, least):
    rows = [(5, "http://a/", "same"), (3, "http://b/", "same"), (9, None, "same"), (3, "http://b/", "same"), (1, "http://c/\r\nX: y", None), (2, "", ""), (None, "http://d/", "same"), (7, "http://é/", "é\r\n\r\n\x00"), (8, "http://l/", "long " * 200_000), (10, "h", "ab"), (11, "h", "ab")]
    rows += [(100 + k, "http://copy/", "copied") for k in range(40)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string")
    assert run(spark, df, least_bytes=least) == expected(rows, least)
    assert run(spark, df.limit(0)) == []


def package(force_zip64, note=b"", deflated_index=False):
    records = [W.record("response", str(k), f"http://x/{k}", "2020-01-01T00:00:00Z", digest(b"p%d" % k), 2, b"p%d" % k, None) for k in range(5)]
    lines, at = [], 0
    for k, r in enumerate(records):
        lines.append(f'x {k} {{"filename": "data.warc", "offset": "{at}", "length": "{len(r)}"}}')
        at += len(r)
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as z:
        with z.open(zipfile.ZipInfo("archive/data.warc"), "w", force_zip64=force_zip64) as f:
            f.write(b"".join(records))
        z.writestr("indexes/index.cdx", "\n".join(lines), zipfile.ZIP_DEFLATED if deflated_index else zipfile.ZIP_STORED)
        z.comment = note
    return sink.getvalue()


@pytest.mark.parametrize("options", [{"force_zip64": False}, {"force_zip64": True}, {"force_zip64": False, "note": b"PK\x05\x06 is no end" * 50}, {"force_zip64": True, "deflated_index": True}])
def test_packages_of_other_writers(options):
    raw = package(**options)
    assert [block for _, block in W.read_package(io.BytesIO(raw), len(raw))] == [b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 2\r\n\r\np%d" % k for k in range(5)]


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = package(True)
    assert W.EOCD64 in raw and W.LOCATOR64 in raw
    assert len(list(W.read_package(io.BytesIO(raw), len(raw)))) == 5


def test_only_ranges_are_read():
    raw = package(True)

    class Source(io.BytesIO):
        total = 0

        def read(self, n=-1):
            out = super().read(n)
            Source.total += len(out)
            return out

    big = Source(raw)
    index = W.ZipIndex(big, len(raw))
    m = index.members["archive/data.warc"]
    Source.total = 0
    list(index.ranges(m, [(0, 10)]))
    assert Source.total == 40
    with pytest.raises(ValueError, match="outside"):
        list(index.ranges(m, [(m.packed - 1, 2)]))


def test_what_isn_t_a_package():
    with pytest.raises(ValueError, match="end of central directory"):
        W.ZipIndex(io.BytesIO(b"x" * 100), 100)
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a", b"x" * 100)
    index = W.ZipIndex(sink, len(sink.getvalue()))
    with pytest.raises(ValueError, match="stored"):
        list(index.ranges(index.members["archive/a"], [(0, 1)]))


def test_braces_and_line_separators_in_urls(spark):
    rows = [(1, "http://h/{id}", "a"), (2, 'http://h/{"x": 1}', "b"), (3, "http://h/\u2028\x85{", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert run(spark, df) == expected(rows)


def indexed(name, data):
    sink = io.BytesIO()
    raw = W.record("response", "1", "http://x/", "2020-01-01T00:00:00Z", digest(b"p"), 1, b"p", None)
    with zipfile.ZipFile(sink, "w") as z:
        z.writestr("archive/a.warc", raw)
        z.writestr("indexes/index.idx", "! meta\n")
        z.writestr(f"indexes/{name}", data.replace(b"LENGTH", b"%d" % len(raw)) if not name.endswith(".gz") else gzip.compress(data.replace(b"LENGTH", b"%d" % len(raw))))
    return list(W.read_package(sink, len(sink.getvalue())))


def test_gzipped_indexes_and_indexes_that_can_t_be_read():
    line = b'!meta {"format": "x"}\nx 2020 {"filename": "a.warc", "offset": 0, "length": LENGTH}\n'
    assert len(indexed("index.cdx.gz", line)) == len(indexed("index.cdxj.gz", line)) == len(indexed("index.cdxj", line + line)) == 1
    with pytest.raises(ValueError, match="CDXJ"):
        indexed("index.cdx", b" CDX N b a m s k r M S V g\nx 2020 http://x/ text/html 200 D - - 9 0 a.warc\n")
    with pytest.raises(ValueError, match="unknown index"):
        indexed("index.lst", line)
