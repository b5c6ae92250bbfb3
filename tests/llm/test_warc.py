"""Both ARC versions, exact round trips, revisits against SQL, edges."""

import gzip
import hashlib

import pytest

from ledgerhawk.llm import warc
from ledgerhawk.plans.harness import duck
from ledgerhawk.session import scratch_path


def arc(version, records):
    desc = f"{version} 0 test\n{warc.FIELDS[version]}\n\n".encode()
    out = b"filedesc://t.arc 0.0.0.0 20010203040506 text/plain %d\n" % len(desc) + desc + b"\n"
    for url, content in records:
        more = b"" if version == 1 else b"200 sum - 0 t.arc "
        out += f"{url} 10.0.0.1 20010203040506 text/html ".encode() + more + b"%d\n" % len(content) + content + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_parse_arc(version):
    records = [("http://a/b c", b"HTTP/1.0 200 OK\r\n\r\nx\ny"), ("dns:a", b""), ("http://b/", b"\n\nfiledesc://no 1 2 3 4\n")]
    data = arc(version, records)
    got = list(warc.parse_arc(warc.inflate(gzip.compress(data[:70]) + gzip.compress(data[70:]))))
    assert [(f["URL"], c) for _, _, f, c in got[1:]] == records and {v for _, v, _, _ in got} == {version}
    assert all(data[o:].startswith(f["URL"].encode()) for o, _, f, _ in got)
    with pytest.raises(ValueError):
        list(warc.parse_arc(data[:-4]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(data + b"rubbish\n"))


def test_warc_round_trip():
    fields = {"URL": "http://a/", "IP-address": "10.0.0.1", "Archive-date": "19990101", "Content-type": "text/html"}
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + bytes(range(256)) + b"\r\n\r\nWARC/1.1\r\n"
    raw = warc.warc_record("response", "<urn:1>", fields, block) + b"\n"
    (head, body), = warc.parse_warc(raw)
    assert body == block and head["warc-date"] == "1999-01-01T00:00:00Z"
    assert head["warc-payload-digest"] == "sha256:" + hashlib.sha256(block[25:]).hexdigest()
    with pytest.raises(ValueError):
        list(warc.parse_warc(raw[:-1]))


def test_converted_files(spark, tmp_path):
    same = b"HTTP/1.0 200 OK\r\n\r\n" + b"p" * 100
    for version, name in ((1, "one.arc"), (2, "two.arc.gz")):
        data = arc(version, [("http://a/", same), ("dns:x", b"10.0.0.1"), ("http://b/", same)])
        (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    target = scratch_path(spark, "test-warc")
    warc.arc_to_warc(spark, str(tmp_path), target)
    rows = warc.read_warc(spark, target).collect()
    assert sorted(r["kind"] for r in rows) == ["resource"] * 2 + ["response"] + ["revisit"] * 3
    first = next(r["record"] for r in rows if r["kind"] == "response")
    assert {r["refers"] for r in rows if r["kind"] == "revisit"} == {first}
    assert all(r["said"] == r["digest"] for r in rows if r["digest"])
    again = scratch_path(spark, "test-warc")
    warc.arc_to_warc(spark, str(tmp_path), again)
    assert sorted(r["record"] for r in warc.read_warc(spark, again).collect()) == sorted(r["record"] for r in rows)


def test_repeated_payloads_equal_sql(spark, tmp_path):
    rows = [(i, f"http://h/{i % 3}", ["short", "é" * 50, "long " * 40, "x" * 99, "y" * 100, "", None][i % 7]) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df.repartition(4).write.parquet(str(tmp_path / "pages"))
    got = sorted(map(tuple, warc.archived(spark, spark.read.parquet(str(tmp_path / "pages"))).collect()))
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    assert got == sorted(con.sql(warc.ORACLE).fetchall())


def test_given_pages(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(str, map(tuple, warc.op10(spark, sf).collect())))
    assert got == sorted(map(str, duck(sf).sql(warc.ORACLE).fetchall()))


def test_edges(spark):
    big = "z" * 3_000_000
    rows = [(None, None, big), (2, "http://a b\n", big), (2, "http://a b\n", big), (3, "u", None), (4, None, "\r\n\r\nWARC/1.1\r\n"), (5, "", "\x00\x1f\x8b")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, offset long, digest string")
    got = warc.archived(spark, df).collect()
    assert sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in got) == \
        [(0, 3_000_000, "revisit", 2), (2, 3_000_000, "response", 0), (2, 3_000_000, "revisit", 2), (3, 0, "response", 0), (4, 14, "response", 0), (5, 4, "response", 0)]
    assert warc.archived(spark, df.limit(0)).count() == 0
