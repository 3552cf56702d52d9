import gzip
import hashlib
import random

import __spark_entry__ as entry
import pytest
from compare import differences, duck
from pyspark.sql import functions as F
from tellerlake.llm import queries, warc
from tellerlake.sources.workspace import new_dir

SF = "/root/testdata/sf0.001"
AWKWARD = "WARC/1.0\r\nWARC-Type: response\r\n\r\nhttp://a 0.0.0.0 20260101000000 text/html 5\n\r\n\r\n\r\n\r\n"


@pytest.mark.parametrize("version", [1, 2])
def test_archives_are_parsed_by_declared_lengths(version):
    rng = random.Random(version)
    records = [(f"http://h/{k} with blanks", "1.2.3.4", "20010203040506", "text/html", rng.choice([b"", b"\n", b"\n\n", rng.randbytes(400), AWKWARD.encode()])) for k in range(40)]
    data = warc.arc_archive(records, version, "x.arc")
    assert list(warc.parse_arc(data)) == records
    assert list(warc.parse_arc(gzip.compress(data[:100]) + gzip.compress(data[100:]))) == records
    with pytest.raises(ValueError, match="shorter"):
        list(warc.parse_arc(warc.arc_archive([("u", "i", "1", "t", b"x" * 50)], version, "x.arc")[:-20]))
    with pytest.raises(ValueError, match="bad header"):
        list(warc.parse_arc(data + b"junk\n"))
    with pytest.raises(ValueError, match="version block"):
        list(warc.parse_arc(b"junk\n"))


@pytest.mark.parametrize("number", [None, 0, 1, -1, -7, 2**63 - 1, -(2**63), 123456789012345678])
def test_identifiers_hold_their_number(number):
    digest = hashlib.sha256(str(number).encode()).hexdigest()
    made = warc.record_id(number, digest)
    assert warc.number_of(made) == number
    assert (made.version, made.variant) == (8, "specified in RFC 4122")


def test_converted_archives_of_other_makers(spark):
    """Content that is not HTTP, or not text, passes unchanged."""
    raw = bytes(range(256)) * 3
    data = warc.arc_archive([("dns:x", "1.1.1.1", "1999", "text/dns", raw), ("http://y", "2.2.2.2", "19991231235959", "text/html", b"HTTP/1.0 200 OK\r\n\r\n" + raw)], 1, "a")
    records = warc.convert(spark.createDataFrame([(bytearray(data),)], "content binary"), "content")
    path = new_dir(spark, "warc-test")
    warc.write(records, path)
    got = sorted(tuple(r) for r in warc.read(spark, path).collect() if r.target)
    digest = hashlib.sha256(raw).hexdigest()
    assert [(g[1], g[2], g[3], g[5], g[6]) for g in sorted(got, key=lambda g: g[1])] == [
        ("dns:x", "1999-01-01T00:00:00Z", "resource", 768, digest),
        ("http://y", "1999-12-31T23:59:59Z", "response", 768, digest),
    ]


@pytest.mark.parametrize("version", [1, 2])
def test_captures_of_other_makers_have_names_and_revisits_of_their_own(spark, version):
    http = b"HTTP/1.0 200 OK\r\nContent-Length: 200\r\n\r\n" + b"p" * 200
    later = [("http://b", "1.1.1.1", "20020101", "text/html", http), ("http://a", "1.1.1.1", "2001", "text/html", http)]
    data = [warc.arc_archive(later, version, "one.arc"), warc.arc_archive([("dns:z", "2.2.2.2", "20030230", "text/dns", b"q" * 150), *later[:1]], version, "two.arc")]
    records = warc.convert(spark.createDataFrame([(bytearray(d),) for d in data], "archive binary"))
    path = new_dir(spark, "warc-test")
    warc.write(records, path, "none")
    got = sorted(warc.read(spark, path).collect(), key=lambda r: (r.date, r.target))
    assert len({r.record_id for r in got}) == 4 and {r.page_id for r in got} == {None}
    first = got[0]
    assert [(r.target, r.date[:10], r.record_type, r.refers_to_id) for r in got] == [
        ("http://a", "2001-01-01", "response", None),
        ("http://b", "2002-01-01", "revisit", first.record_id),
        ("http://b", "2002-01-01", "revisit", first.record_id),
        ("dns:z", "2003-02-30", "resource", None),
    ]
    assert [r.kind for r in got][-1] == "text/dns" and {r.payload_bytes for r in got[:3]} == {200}
    whole = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect())
    about = [(f, b) for f, b in warc.parse_warc(whole) if f["warc-type"] == "warcinfo"]
    assert sorted(f["warc-filename"] for f, _ in about) == ["one.arc", "two.arc"]
    assert all(f"conformsTo: ARC/{version}\r\n".encode() in b and f["content-type"] == warc.ABOUT for f, b in about)


def test_edge_rows(spark):
    long, small = "x" * 100, "y" * 99
    rows = [(5, "http://a b\r\n", long), (2, None, long), (9, "", long), (None, "u", long), (7, "u", small), (8, "u", small)]
    rows += [(20, "u", None), (21, "u", ""), (30, "u", AWKWARD * 3), (31, "u", AWKWARD * 3), (32, "u", AWKWARD * 3 + " "), (40, "é/日", "é" * 50), (41, "u", "é" * 50)]
    rows += [(None, "u", "n" * 200), (None, "v", "n" * 200), (60, "u", "z" * 300), (60, "u", "z" * 300), (61, "u", "z" * 300), (70, "u", "big" * 1_000_000)]
    pages = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, block string")
    got = {}
    for r in warc.archive_pages(pages).collect():
        got.setdefault(r.page_id, []).append((r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[2] == [(100, sha(long), "response", None)]
    assert got[5] == got[9] == [(100, sha(long), "revisit", 2)]
    assert got[7] == got[8] == [(99, sha(small), "response", None)]
    assert got[20] == got[21] == [(0, sha(""), "response", None)]
    assert got[31] == [(len(AWKWARD) * 3, sha(AWKWARD * 3), "revisit", 30)]
    assert got[32][0][2] == "response"
    assert got[41] == [(100, sha("é" * 50), "revisit", 40)]
    assert sorted(got[None]) == sorted([(100, sha(long), "revisit", 2)] + [(200, sha("n" * 200), "response", None)] * 2)
    assert got[60] == [(300, sha("z" * 300), "response", None)] * 2 and got[61][0][2:] == ("revisit", 60)
    assert got[70][0][0] == 3_000_000
    assert sum(map(len, got.values())) == len(rows)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_query_equals_sql_over_the_whole_table(spark):
    found = differences(queries.QUERIES["op7_warc"](spark, SF), duck(SF), entry.oracle_sql()["op7_warc"])
    assert not found, found


@pytest.mark.parametrize("compression,plain", [("none", bytes), ("gzip", gzip.decompress)])
def test_files_are_warc_files(spark, compression, plain):
    path = new_dir(spark, "warc-test")
    records = warc.convert(warc.pages_to_arc(spark.read.parquet(f"{SF}/pages.parquet")))
    warc.write(records, path, compression)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    contents = [plain(bytes(r.content)) for r in files.where(F.col("length") > 0).collect()]
    assert any(contents)
    for content in filter(None, contents):
        assert content.startswith(b"WARC/1.0\r\n") and content.endswith(b"\r\n\r\n")
    assert warc.read(spark, path).count() == 50
