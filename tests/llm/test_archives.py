import gzip
import hashlib

import pytest

from ledgerloom.llm import archives

PAGES = "page_id long, url string, html string, digest int, record string"


def brute(rows, least=1000):
    out = []
    for i, (page, _, html, *_) in enumerate(rows):
        data = (html or "").encode()
        same = [(p if p is not None else -1, j) for j, (p, _, h, *_) in enumerate(rows) if (h or "") == (html or "")]
        top = max(p for p, _ in same)
        revisit = len(data) >= least and len(same) > 1 and (page if page is not None else -1) != top
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_and_revisits(spark):
    big, inner = "<p>x</p>\r\n\r\nWARC/1.0\r\n" * 60, "é" * 600
    rows = [(1, "http://a b/\n", big, 1, "r"), (2, "http://a", big, 1, "r"), (3, None, big, 1, "r"), (4, "u", inner, 1, "r"), (9, "u", inner, 1, "r")]
    rows += [(5, "u", None, 1, "r"), (6, "u", "", 1, "r"), (7, "u", "short", 1, "r"), (8, "u", "short", 1, "r"), (None, "u", "n" * 1000, 1, "r"), (10, "u", "z" * 3_000_000, 1, "r")]
    got = archives.pages_through_archives(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == brute(rows)
    assert {r.url for r in got} >= {"http://a%20b/%20".replace("/%20", "/%20"), "about:blank"}


def test_repeated_rows_have_one_response(spark):
    rows = [(1, "u", "y" * 2000, 1, "r")] * 3
    got = archives.pages_through_archives(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(r.record_type for r in got) == ["response", "revisit", "revisit"]
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {1}


def test_empty_table(spark):
    assert archives.pages_through_archives(spark.createDataFrame([], PAGES)).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    block = archives.arc_version_block("name", version)
    data = block + archives.arc_record("http://x/ y", b"HTTP/1.1 200 OK\r\n\r\nbody\nwith lines\n", version, 0, "name")
    data += archives.arc_record("http://z", b"", version, 0, "name") + b"\n"
    for form in (data, gzip.compress(data), gzip.compress(data[:50]) + gzip.compress(data[50:])):
        records = list(archives.read_arc(form))
        assert [(r.url, r.content, r.truncated) for r in records] == [
            ("http://x/%20y", b"HTTP/1.1 200 OK\r\n\r\nbody\nwith lines\n", False),
            ("http://z", b"", False),
        ]


def test_mixed_versions_truncation_and_errors():
    one = archives.arc_version_block("a", 1) + archives.arc_record("http://one", b"1", 1, 0, "a") + b"\n"
    two = archives.arc_version_block("b", 2) + archives.arc_record("http://two", b"22", 2, 0, "b")
    assert [r.url for r in archives.read_arc(one + two)] == ["http://one", "http://two"]
    assert [r.truncated for r in archives.read_arc((one + two)[:-1])] == [False, True]
    with pytest.raises(ValueError, match="header"):
        list(archives.read_arc(archives.arc_version_block("a", 1) + b"\nno header at all\n"))


def test_dates():
    assert archives.warc_date("19990203040506") == "1999-02-03T04:05:06Z"
    assert archives.warc_date("199902") == "1999-02-01T00:00:00Z"
    assert archives.warc_date("bad") == "1970-01-01T00:00:00Z"


def test_written_files_are_plain_gzip_warc(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "w" * (900 + i), 1, "r") for i in range(40)]
    arc = archives.write_arc(spark.createDataFrame(rows, PAGES), str(tmp_path / "arc"), archive_bytes=5000)
    archives.convert(spark, arc, str(tmp_path / "warc"), archive_bytes=5000)
    files = sorted((tmp_path / "warc").glob("part-*"))
    assert len(files) > 3 and len(list((tmp_path / "arc").glob("part-*"))) > 3
    text = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: response") == 40
