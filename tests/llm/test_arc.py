import gzip
import hashlib
import zlib

import pytest

from paperloom.llm import arc_convert as A


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    bodies = [b"", b"plain", b"with\nlines\n\nand http://x 1.2.3.4 20000101000000 text/html 9\n", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + bytes(range(256)), "é ".encode() * 50]
    data = A.write_arc(((f"http://a/{i}", "20240229123456", "text/html", b) for i, b in enumerate(bodies)), version, "x.arc")
    got = list(A.read_arc(data))
    assert [r.body for r in got] == bodies and [r.fields["url"] for r in got] == [f"http://a/{i}" for i in range(5)]
    assert set(got[0].fields) == set(A.FIELDS[version])
    assert all(data[r.offset :].startswith(r.fields["url"].encode()) for r in got)


def test_arc_errors():
    data = A.write_arc([("http://a", "20240229123456", "text/html", b"12345")], 1, "x.arc")
    with pytest.raises(ValueError):
        list(A.read_arc(data[:-4]))
    with pytest.raises(ValueError):
        list(A.read_arc(data + b"http://b only three 5\nabcde\n"))
    with pytest.raises(ValueError):
        list(A.read_arc(b"filedesc://x 0.0.0.0 20000101000000 text/plain 4\n3 0 \n"))


def test_dates():
    assert A.warc_date("20240229123456") == "2024-02-29T12:34:56Z"
    assert A.warc_date("1999") == "1999-01-01T00:00:00Z"
    assert A.warc_date("20241399") == A.warc_date("") == "1970-01-01T00:00:00Z"


def test_warc_records_read_back():
    record = A.ArcRecord({"url": "http://a/é", "ip": "1.2.3.4", "date": "20240229123456", "type": "text/html"}, b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\nWARC/1.1\r\n", 0)
    whole = A.to_warc(record, {"X-Page-Id": "1"})
    again = A.to_warc(record, {"X-Page-Id": "2"}, {"WARC-Refers-To": "<urn:x>"})
    plain = A.to_warc(A.ArcRecord(record.fields, b"no head", 0), {})
    got = list(A.read_warc(b"".join(r + b"\r\n\r\n" for r in (whole, again, plain))))
    assert [f["WARC-Type"] for f, _ in got] == ["response", "revisit", "resource"]
    assert got[0][1] == record.body and got[1][1] == b"HTTP/1.1 200 OK\r\n\r\n" and got[2][1] == b"no head"
    assert got[0][0]["WARC-Payload-Digest"] == got[1][0]["WARC-Payload-Digest"]
    with pytest.raises(ValueError):
        list(A.read_warc(whole))


def test_pages(spark, tmp_path):
    big = "<p>é</p>" * 200
    pages = [(1, "http://a", big), (2, "http://b", big), (7, "http://c d\n", big), (7, "http://c d\n", big), (3, "http://e", "small"), (4, "http://f", "small"), (5, None, None), (6, "http://g", ""), (None, "http://h", big), (8, "http://i", "x" * 1000), (9, "http://j", "x" * 999), (10, "http://k", "WARC/1.1\r\n\r\n\r\n" * 9), (11, "http://l", "y" * 3_000_000)]
    df = spark.createDataFrame([(*p, "mine", "mine") for p in pages], "page_id long, url string, html string, digest string, record string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in A.convert(df, str(tmp_path / "w")).collect()), key=str)
    last = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(last.get(h, i), i)
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        to = last.get(h)
        back = i is not None and to is not None and to > i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if back else "response", to if back else None))
    assert got == sorted(want, key=str)
    records = [f for p in (tmp_path / "w").glob("part-*") for f, _ in A.read_warc(gzip.decompress(p.read_bytes()))]
    ids = {f["WARC-Record-ID"] for f in records}
    assert len(ids) == len(records) == len(pages)
    assert all(f["WARC-Refers-To"] in ids for f in records if f["WARC-Type"] == "revisit")


def test_no_pages(spark):
    assert A.convert(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_long_urls_stay_whole(spark):
    urls = ["http://a/" + "x" * 5_000 + end for end in ("1", "2")]
    df = spark.createDataFrame([(i, u, "small") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = A.convert(df).collect()
    assert sorted(r.target_uri for r in got) == urls and len({r.record_id for r in got}) == 2


def test_a_member_for_each_record_and_files_by_bytes(spark, tmp_path):
    """Every record can be read by itself; files end before they grow beyond the bound."""
    rows = [(i % 40 if i % 7 else None, f"http://a/{i % 40}", f"{i} " * (1 + 40 * (i % 50))) for i in range(400)] + [(500, "http://b", "".join(chr(33 + i * i % 90) for i in range(200_000)))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    A.write_archives(frame, str(tmp_path / "w"), file_bytes=20_000)
    n = 0
    for file in (tmp_path / "w").glob("part-*"):
        data, members = file.read_bytes(), 0
        rest = data
        while rest.strip(b"\0"):
            one = zlib.decompressobj(31)
            found = list(A.read_warc(one.decompress(rest)))
            assert len(found) == 1
            rest, members = one.unused_data, members + 1
        assert members == 1 or len(data) <= 20_001
        n += members
    assert n == len(rows)
    got = A.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len({r.record_id for r in got}) == len(rows)
