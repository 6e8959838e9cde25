"""WARC archives: round trips, damage, and the query against a plain statement of its contract."""

import gzip
import hashlib
import random
import re
from collections import Counter

import pytest
from conftest import SF

from changelens.llm import warc
from changelens.llm.common import table

CLASHING = ("type", "record_id", "digest", "refers_to", "payload", "_row", "n_bytes", "status", "key", "n")


def pages(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


def plain(rows):
    """Counter of the contract's rows; of rows that repeat the smallest page_id one is the response."""
    firsts, out = {}, Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and i is not None:
            firsts[body] = min(firsts.get(body, i), i)
    stored = set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        again = len(body) >= 100 and body in stored
        stored.add(body)
        out[i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", firsts.get(body) if again else None] += 1
    return out


def as_counter(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


LONG = "".join(f"<p>{i}\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>" for i in range(40_000))
SAME = "<html>" + "é" * 60 + "</html>"
ODD = [
    (1, "http://a/ b\r\nX: y", "x"), (2, None, None), (3, "http://a", ""), (4, "http://a", SAME), (5, "http://b", SAME), (5, "http://b", SAME),
    (0, "http://c", "y" * 99), (6, "http://c", "y" * 99), (7, "http://d", "y" * 100), (8, "http://d", "y" * 100), (None, "http://e", "y" * 100),
    (None, None, "z" * 200), (None, None, "z" * 200), (9, "http://long", LONG), (10, "http://l", "\r\n\r\n"), (11, "http://l", "\r\n" * 300), (12, "u", "0\r\n\r\n"),
    (13, "http://x\x7f  é", "\x00\x01 €😀" * 2000), (14, "", "a" * warc.SEGMENT_BYTES)]


def test_odd_pages(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages(spark, ODD), path, records_per_file=7)
    got = warc.captures(spark, path)
    assert as_counter(got) == plain(ODD)
    assert {r.status for r in got.collect()} == {"complete"}
    texts = {r.page_id: bytes(r.payload).decode() for r in warc.payloads(spark, path).where("type = 'response'").collect()}
    assert texts[9] == LONG and texts[11] == "\r\n" * 300 and texts[13] == ODD[-2][2]
    urls = {r.page_id: r.url for r in got.collect()}
    assert urls[1] == "http://a/%20b%0D%0AX:%20y" and urls[2] is None and urls[14] == "" and urls[13] == "http://x%7F%C2%A0 é"


def test_repeated_smallest_page_is_stored_once(spark, tmp_path):
    rows = [(3, "u", SAME)] * 3 + [(4, "u", SAME)]
    warc.write_archives(pages(spark, rows), str(tmp_path / "w"))
    assert as_counter(warc.captures(spark, str(tmp_path / "w"))) == plain(rows)
    assert warc.payloads(spark, str(tmp_path / "w")).where("payload IS NOT NULL").count() == 1


def test_empty_table(spark, tmp_path):
    warc.write_archives(pages(spark, []).limit(0), str(tmp_path / "w"))
    assert warc.captures(spark, str(tmp_path / "w")).count() == 0


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in table(spark, SF, "pages").collect()]
    got = warc.query(spark, SF)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert as_counter(got) == plain(rows)


@pytest.mark.parametrize("size", [1, 2, 7, 4096])
def test_chunks(size):
    rng = random.Random(size)
    for n in (0, 1, size - 1, size, size + 1, 50):
        body = bytes(rng.choice(b"a\r\n0;") for _ in range(n))
        assert warc.dechunked(warc.chunked(body, size)) == body


def test_foreign_chunks():
    assert warc.dechunked(b"3 ;x=y\r\nabc\r\n0A;q\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc0123456789"
    for bad in (b"", b"3\r\nab", b"3\r\nabc\r\n", b"x\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"0\r\n\r\nmore", b"0\r\nTrailer"):
        assert warc.dechunked(bad) is None
    assert warc.http_payload(b"HTTP/1.0 200 OK\r\ntransfer-encoding:\tChunked\r\n\r\n1\r\nx\r\n0\r\n\r\n") == (b"x", "complete")
    assert warc.http_payload(b"no head") == (None, "no head")


def archive(folder, name, parts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(b"".join(gzip.compress(p) for p in parts))  # a member for each record, as other writers do


def told(spark, folder):
    return {r.record_id: (r.status, None if r.payload is None else bytes(r.payload)) for r in warc.payloads(spark, str(folder)).collect()}


def test_segments_from_other_archives(spark, tmp_path):
    """Segments out of order over several files, folded and lower-case fields; every kind of damage is named."""
    body = warc.HTTP_HEAD + warc.chunked(b"0123456789" * 30, 50)

    def cut(rid):
        return list(warc.segments([("WARC-Type", "response"), ("WARC-Record-ID", f"<{rid}>"), ("Content-Type", "application/http")], rid, body, 100))

    end = warc.END
    good, gap, headless, endless, wrong, clash, twice = map(cut, ("good", "gap", "headless", "endless", "wrong", "clash", "twice"))
    n = len(good)
    wrong[-1] = wrong[-1].replace(b"Total-Length: %d" % len(body), b"Total-Length: %d" % (len(body) + 1))
    other = clash[2][:-1] + bytes([clash[2][-1] ^ 1])
    folded = b"WARC/1.0\r\nwarc-type: resource\r\nwarc-record-id:\r\n <plain>\r\ncontent-length: 5" + end + b"\r\n\r\n!"
    one = [good[2], *gap[:1], *gap[2:], *headless[1:], folded, *endless[:-1], twice[1]]
    two = [*reversed(good[3:]), good[0], *wrong, *clash, other, *reversed(twice)]
    archive(tmp_path / "w", "a.warc.gz", [r + end for r in one])
    archive(tmp_path / "w", "b.warc.gz", [r + end for r in two] + [good[1]])  # ends without line breaks
    want = {"good": ("complete", b"0123456789" * 30), "gap": ("missing segment", None), "headless": ("missing segment", None),
            "endless": ("missing segment", None), "wrong": ("wrong length", None), "clash": ("conflicting segments", None),
            "twice": ("complete", b"0123456789" * 30), "plain": ("complete", b"\r\n\r\n!")}
    assert n > 4 and told(spark, tmp_path / "w") == want


def test_damaged_archives(spark, tmp_path):
    rec = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), ("Content-Type", "application/http")], warc.HTTP_HEAD + warc.chunked(b"abc")) + warc.END
    archive(tmp_path / "w", "a.warc.gz", [rec, rec.replace(b"<a>", b"<b>").replace(b"3\r\nabc", b"4\r\nabc"), rec.replace(b"<a>", b"<c>")[:-12]])
    archive(tmp_path / "w", "b.warc.gz", [b"noise" + warc.END + rec.replace(b"<a>", b"<d>")])
    got = told(spark, tmp_path / "w")
    assert got == {"a": ("complete", b"abc"), "b": ("broken chunks", None), "c": ("cut off", None), None: ("cut off", None), "d": ("complete", b"abc")}


def test_revisit_without_its_origin(spark, tmp_path):
    again = warc.record([("WARC-Type", "revisit"), ("WARC-Record-ID", "<r>"), ("Page-ID", 4), ("WARC-Refers-To", "<gone>")], warc.REVISIT_HEAD)
    archive(tmp_path / "w", "a.warc.gz", [again + warc.END])
    (row,) = warc.captures(spark, str(tmp_path / "w")).collect()
    assert (row.page_id, row.status, row.payload_bytes, row.refers_to) == (4, "missing origin", None, None)


def test_plain_archives_are_refused(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(warc.record([("WARC-Type", "resource")], b"x") + warc.END)
    with pytest.raises(Exception, match=re.escape("is not a gzip archive")):
        warc.payloads(spark, str(tmp_path / "w")).collect()
