"""Archives: exact round trips, both header versions, revisits."""

import hashlib

import pytest

from longspan.llm import warc as A

TRICKY = ["", None, "short", "x" * 99, "y" * 100, "é" * 60, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5, "\nhttp://x 0.0.0.0 1 text/html 5\nhello" * 9,
          "ends in the cut \r\n\r\nWARC/1.1\r\n", "ends in part of it " + "z" * 100 + "\r\n\r\nWARC/1.1", "\r\n\r\n" * 40, "\n" * 200, "long " * 60_000,
          "HTTP/1.0 200 OK\r\n\r\nnested" + "n" * 100]


def expected(rows):
    first = {}
    for i, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, h in rows:
        b = (h or "").encode()
        again = b in first and i != first[b]
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def test_query(spark):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(50 + i, t) for i, t in enumerate(TRICKY)] + [(None, TRICKY[4]), (3, TRICKY[3]), (4, TRICKY[4])]
    urls = ["http://a.example/x y\n", None, "ftp://b/é", "dns:c", ""]
    pages = spark.createDataFrame([(i, urls[k % 5], t, "d") for k, (i, t) in enumerate(rows)], "page_id bigint, url string, html string, digest string")
    got = A.digest(pages.repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)
    assert A.digest(pages.limit(0)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_files_are_plain_archives(spark, tmp_path, version):
    import gzip
    pages = spark.createDataFrame([(1, "http://a/1", "first " * 30), (2, "http://a/2", "first " * 30)], "page_id bigint, url string, html string")
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    A.write_arc(pages.coalesce(1), arc, version=version)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "arc").glob("part-*")))
    assert data.startswith(f"filedesc://pages.arc 0.0.0.0 {A.DATE} text/plain".encode())
    A.convert(spark, arc, warc)
    for p in (tmp_path / "warc").glob("part-*"):
        data = gzip.decompress(p.read_bytes())
        while data:  # a reader that knows nothing but the format
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            n = int(head.split(b"Content-Length: ")[1])
            assert rest[n:n + 4] == b"\r\n\r\n"
            data = rest[n + 4:]
    kinds = {r.page_id: (r.record_type, r.url, r.date) for r in A.read_warc(spark, warc).collect()}
    assert kinds == {1: ("response", "http://a/1", "1996-12-31T23:59:59Z"), 2: ("revisit", "http://a/2", "1996-12-31T23:59:59Z")}


def test_header_lines():
    one = A.parse_arc_line("http://a/ 1.2.3.4 19970101000000 text/html 12")
    two = A.parse_arc_line("http://a/ 1.2.3.4 19970101000000 text/html 200 abc - 0 f.arc 12")
    assert one["length"] == two["length"] == 12 and two["status"] == "200"
    for bad in ("http://a/ 1.2.3.4 1997 text/html", "http://a/ 1.2.3.4 1997 text/html x"):
        with pytest.raises(ValueError):
            A.parse_arc_line(bad)
    assert A.warc_date("1997") == "1997-01-01T00:00:00Z" and A.warc_date("19970203040506") == "1997-02-03T04:05:06Z"
    record = A.warc_record(one, b"plain bytes \xff")
    assert b"WARC-Type: resource" in record and record.endswith(b"plain bytes \xff")


def test_declared_lengths_are_held(spark, tmp_path):
    path = tmp_path / "bad"
    path.mkdir()
    import gzip
    (path / "x.gz").write_bytes(gzip.compress(b"http://a/ 0.0.0.0 19970101000000 text/html 500\nshort"))
    with pytest.raises(Exception, match="declared length"):
        A.convert(spark, str(path), str(tmp_path / "out"))
