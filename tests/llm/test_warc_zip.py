from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zipfile

import pytest

from merchant_features.llm import warc_zip as Z

SCHEMA = "page_id long, url string, html string, same string"
PAGES = [
    (3, "http://a/ü?x=1 2", "<p>é</p>", "s"), (1, "http://b", "<p>é</p>", "s"), (2, None, None, "s"), (5, "http://c\r\nX: y", "", "s"),
    (7, "http://d", "long " * 50_000, "s"), (8, "http://e", "\r\n\r\nWARC/1.1\r\n", "s"), (1, "http://b", "<p>é</p>", "s"),
    (None, "http://f", "only null", "s"), (None, "http://f", "<p>é</p>", "s"),
]


def plain(pages):
    firsts = {}
    for page, _, html, _ in pages:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    out = []
    for page, _, html, _ in pages:
        payload = (html or "").encode()
        first = firsts.get(html or "")
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def round_trip(spark, tmp_path, df, **options):
    packages = Z.write_packages(df, f"file://{tmp_path}/packages", **options)
    rows = Z.read_records(packages).collect()
    as_long = lambda x: None if x is None else int(x)
    return packages, sorted(
        ((as_long(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, as_long(r.refers_to)) for r in rows), key=repr
    ), rows


@pytest.mark.parametrize("package_bytes", [Z.PACKAGE_BYTES, 200])
def test_round_trip(spark, tmp_path, package_bytes):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(2)
    packages, got, rows = round_trip(spark, tmp_path, df, package_bytes=package_bytes)
    assert got == plain(PAGES)
    assert packages.count() >= (5 if package_bytes == 200 else 1)
    payloads = {r.page_id: bytes(r.payload) for r in rows if r.payload is not None}
    assert payloads["7"] == b"long " * 50_000 and payloads["8"] == b"\r\n\r\nWARC/1.1\r\n"


def test_small_payloads_are_responses(spark, tmp_path):
    df = spark.createDataFrame(PAGES, SCHEMA)
    _, got, _ = round_trip(spark, tmp_path, df, least_bytes=1)
    assert [r for r in got if r[1] == 0] == [r for r in plain(PAGES)[0:0]] + sorted(
        [(2, 0, r[2], "response", None) for r in got if r[0] == 2] + [(5, 0, r[2], "response", None) for r in got if r[0] == 5], key=repr
    )


def test_empty_table(spark, tmp_path):
    packages, got, _ = round_trip(spark, tmp_path, spark.createDataFrame([], SCHEMA))
    assert packages.count() == 0 and got == []


def test_ranges_are_read_in_parallel(spark, tmp_path):
    """As many tasks read as there are ranges, whatever adaptive execution thinks of their tiny rows."""
    rows = [(k, f"http://x/{k}", f"page {k} " * 50) for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    packages = Z.write_packages(df, f"{tmp_path}/packages")
    records = Z.read_records(packages)
    n = packages.count()
    assert n > 4 and records.rdd.getNumPartitions() == n
    assert {int(r.page_id) for r in records.collect()} == set(range(40))


def test_packages_are_plain_zip_and_gzip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, SCHEMA).coalesce(1)
    packages = Z.write_packages(df, f"{tmp_path}/packages")
    path = packages.first().path
    with zipfile.ZipFile(path) as package:
        assert package.testzip() is None and {i.compress_type for i in package.infolist()} == {zipfile.ZIP_STORED}
        text = gzip.decompress(package.read(Z.WARC_MEMBER))
    assert text.count(b"WARC/1.1\r\nWARC-Type") == len(PAGES)
    assert b"\r\nX: y" not in text.split(b"\r\n\r\n", 1)[0]


def members(data: bytes):
    with io.BytesIO(data) as file:
        return Z.central_directory(file, len(data))


def test_directories_equal_the_standard_library():
    for force in (False, True):
        sink = io.BytesIO()
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
            for k in range(5):
                with package.open(f"dir/é{k}", "w", force_zip64=force) as member:
                    member.write(b"x" * k * 100)
            package.comment = b"a comment PK\x05\x06"[:9]
        data = sink.getvalue()
        found = members(data)
        assert [m.name for m in found] == [f"dir/é{k}" for k in range(5)]
        for k, m in enumerate(found):
            start = Z.data_offset(io.BytesIO(data), m)
            assert data[start : start + m.size] == b"x" * k * 100


def test_zip64_end_records(monkeypatch):
    # more members than 16 bits hold: the standard library writes ZIP64 end records
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as package:
        for k in range(7):
            package.writestr(str(k), str(k))
    data = sink.getvalue()
    assert b"PK\x06\x06" in data and [m.name for m in members(data)] == list("0123456")


def test_zip64_sizes_in_the_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as package:
        package.writestr("a", b"y" * 200)
        package.writestr("b", b"z" * 300)
    data = sink.getvalue()
    for m, want in zip(members(data), (b"y" * 200, b"z" * 300), strict=True):
        start = Z.data_offset(io.BytesIO(data), m)
        assert data[start : start + m.size] == want


def test_what_is_not_a_package():
    with pytest.raises(ValueError):
        members(b"no zip at all" * 10)
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("a", "b" * 100)
    with pytest.raises(ValueError):
        Z.data_offset(io.BytesIO(sink.getvalue()), members(sink.getvalue())[0])
