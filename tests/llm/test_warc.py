"""ARC files to WARC files and back."""

import base64
import glob
import gzip
import hashlib
import re

import pytest
from pyspark.errors import PythonException

from quarry.llm import warc
from quarry.llm.queries import op13_warc
from quarry.session import scratch_path

SCHEMA = "page_id long, url string, html string, record_id string, bytes int"
TRICKY = "a\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\nhttp://x 0.0.0.0 20040101000000 text/html 3\nabc\n\n"


def rows():
    out = [(k, f"http://host/{k}", text) for k, text in enumerate(
        ["<p>one</p>", None, "", "<p>one</p>", TRICKY, "ends\n", "ends\r\n", "\n\nbegins", "ü" * 70_000, TRICKY, "\x00\x0b"])]
    return out + [(7, "dup id", "other"), (3, None, "<p>one</p>"), (None, "", ""), (None, "a b", "only"), (20, None, "only")]


def want(table):
    first = {}
    for k, _, html in table:
        body = (html or "").encode()
        old = first.get(body, (True, 0))
        first[body] = min(old, (k is None, k or 0)) if body in first else (k is None, k or 0)
    out, seen = [], set()
    for k, _, html in sorted(table, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        refers = first[body][1] if not first[body][0] else None
        out.append((k, len(body), digest, "revisit", refers) if body in seen else (k, len(body), digest, "response", None))
        seen.add(body)
    return sorted(out, key=repr)


def frame(spark, table):
    return spark.createDataFrame([(*r, "x", 1) for r in table], SCHEMA)


def texts(path):
    return [gzip.open(f, "rb").read() for f in sorted(glob.glob(path.removeprefix("file:") + "/**/*.gz", recursive=True))]


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version):
    arcs, archive = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    warc.write_arc(frame(spark, rows()), arcs, version)
    warc.convert(spark, [arcs], archive)
    got = sorted((tuple(r) for r in warc.resolved(warc.read_warc(spark, archive)).collect()), key=repr)
    assert got == want(rows())
    files = [t for t in texts(archive) if t]
    assert all(t.startswith(b"WARC/1.0\r\n") and t.endswith(b"\r\n\r\n") for t in files)
    assert sum(t.count(b"\r\nWARC-Type: warcinfo\r\n") for t in files) == len([t for t in texts(arcs) if t])
    for text in texts(arcs):  # offsets of version 2 are places in the file
        for line in re.findall(rb"(?m)^http://host\S* 0\.0\.0\.0 .*$", text) if version == 2 else []:
            assert text[int(line.split()[7]):].startswith(line)


def written(spark, text):
    path = scratch_path(spark, "old-arc")
    spark.createDataFrame([(text.removesuffix("\n"),)], "value string").coalesce(1).write.option("compression", "gzip").text(path)
    return path


def arc(version, records, fields):
    block = f"{version} 0 Archive\n{' '.join(fields)}\n"
    head = f"filedesc://old.arc 0.0.0.0 19960923142103 text/plain {len(block)}\n"
    if version == 2:
        head = f"filedesc://old.arc 0.0.0.0 19960923142103 text/plain 200 - - 0 old.arc {len(block)}\n"
    return head + block + "\n" + "".join(f"{line} {len(body)}\n{body}\n" for line, body in records)


def test_files_of_other_writers(spark):
    page = "HTTP/1.0 200 OK\r\nContent-Type: text/html\r\nX-Row-Id: 4\r\n\r\n<p>"
    one = arc(1, [("dns:host 1.2.3.4 199609231421 text/dns", "host. 1 IN A 1.2.3.4\n"),
                  ("http://host/a b 1.2.3.4 19960923142103 text/html; charset=x", page),
                  ("http://host/c 1.2.3.4 19960923142104999 no-type", page)], warc.FIELDS[1])
    two = arc(2, [("http://host/z 1.2.3.4 19970101000000 text/html 200 - - 77 old.arc", page + "z")], warc.FIELDS[2])
    archive = scratch_path(spark, "warc")
    paths = [written(spark, one), written(spark, two)]
    warc.convert(spark, paths, archive)
    got = {(r["uri"], r["date"]): r for r in warc.read_warc(spark, archive).collect()}
    assert {k: v["record_type"] for k, v in got.items()} == {
        ("dns:host", "1996-09-23T14:21:00Z"): "resource", ("http://host/z", "1997-01-01T00:00:00Z"): "response",
        ("http://host/a b", "1996-09-23T14:21:03Z"): got["http://host/a b", "1996-09-23T14:21:03Z"]["record_type"],
        ("http://host/c", "1996-09-23T14:21:04Z"): got["http://host/c", "1996-09-23T14:21:04Z"]["record_type"]}
    same = [got["http://host/a b", "1996-09-23T14:21:03Z"], got["http://host/c", "1996-09-23T14:21:04Z"]]
    assert sorted(r["record_type"] for r in same) == ["response", "revisit"]
    again, first = sorted(same, key=lambda r: r["record_type"], reverse=True)
    assert again["first_id"] == first["record_id"] and again["digest"] == first["digest"]
    ids = {r["record_id"] for r in got.values()}
    assert len(ids) == 4 and all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", i) for i in ids)
    second = scratch_path(spark, "warc")
    warc.convert(spark, paths, second)
    assert {r["record_id"] for r in warc.read_warc(spark, second).collect()} == ids
    large = scratch_path(spark, "warc")
    warc.convert(spark, paths, large, least_bytes=100)
    assert warc.read_warc(spark, large).where("record_type = 'revisit'").count() == 0


@pytest.mark.parametrize("text", ["no header line at all\n", arc(1, [("http://h 1.1.1.1 19960923142103 text/html", "abc")], warc.FIELDS[1])[:-3],
                                  arc(1, [("http://h 1.1.1.1 19960923142103 text/html", "abc")], warc.FIELDS[1]).replace(" 3\nabc", " 2\nabc")])
def test_broken_files_raise(spark, text):
    with pytest.raises(PythonException):
        warc.convert(spark, [written(spark, text)], scratch_path(spark, "warc"))


def test_query_and_empty_table(spark, tmp_path):
    frame(spark, rows()).drop("record_id").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((tuple(r) for r in op13_warc(spark, str(tmp_path)).collect()), key=repr)
    assert got == want(rows())
    frame(spark, []).write.parquet(str(tmp_path / "none" / "pages.parquet"))
    assert op13_warc(spark, str(tmp_path / "none")).collect() == []
