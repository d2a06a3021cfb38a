import base64
import gzip
import hashlib

import pytest

from paralane.llm.warc import archived_pages, assemble, read_records, records, unzipped, write_archives

SCHEMA = "page_id long, url string, html string, record_type string, digest string"
TRICKY = "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nafter"


def pages(spark, rows):
    return spark.createDataFrame([(i, url, html, "x", "y") for i, url, html in rows], SCHEMA)


ROWS = [
    (1, "http://a/", "same"), (5, "http://b/", "same"), (3, None, "same"), (2, "http://c/", TRICKY), (4, "http://d/\r\nX: y", "é漢😀" * 10),
    (6, "", None), (7, "http://e/", ""), (8, "http://f/", "long " * 200_000), (9, "http://g/", "\r\n\r\n"), (5, "http://b/", "same"),
]


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        newest = max(j for j, _, other in rows if (other or "").encode() == data)
        revisit = newest != i and len(data) >= least
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", newest if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back(spark, least):
    found = archived_pages(pages(spark, ROWS), least).collect()
    assert sorted(map(tuple, found), key=str) == expected(ROWS, least)


def test_a_null_id_is_smaller_than_others(spark):
    found = archived_pages(pages(spark, [(None, None, "x"), (2, None, "x"), (None, None, "z")])).collect()
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in found) == [
        (0, "response", 0), (0, "revisit", 2), (2, "response", 0),
    ]


def test_rows_of_one_id_keep_their_records(spark, tmp_path):
    rows = [(None, None, "x"), (2, None, "x"), (None, None, "zzz"), (3, None, "zzz"), (4, "u", "long"), (4, "v", "other"), (1, None, "other"), (4, "u", "long"), (0, None, "long")]
    found = archived_pages(pages(spark, rows)).collect()
    assert sorted((tuple(r)[:2] + tuple(r)[3:] for r in found), key=str) == sorted([
        (None, 1, "revisit", 2), (2, 1, "response", None), (None, 3, "revisit", 3), (3, 3, "response", None), (4, 4, "response", None),
        (4, 5, "response", None), (1, 5, "revisit", 4), (4, 4, "response", None), (0, 4, "revisit", 4),
    ], key=str)
    write_archives(pages(spark, rows), str(tmp_path / "warc"))
    stored = read_records(spark, str(tmp_path / "warc")).collect()
    whole = {r["record_id"]: r for r in stored}
    assert len(whole) == len(stored) == 3 * len(rows)
    revisits = [r for r in stored if r["record_type"] == "revisit"]
    assert len(revisits) == 4 and all(whole[r["refers_to"]]["digest"] == r["digest"] for r in revisits)
    sides = assemble(read_records(spark, str(tmp_path / "warc"))).select("request.record_id", "metadata.record_id").collect()
    assert len({x for pair in sides for x in pair}) == 2 * len(rows)


def test_one_nested_row_per_capture(spark, tmp_path):
    write_archives(pages(spark, ROWS[:-1]), str(tmp_path / "warc"))
    rows = read_records(spark, str(tmp_path / "warc"))
    assert rows.count() == 3 * 9
    whole = {r["record_id"]: r for r in assemble(rows).collect()}
    assert len(whole) == 9
    tricky = whole["<urn:page:2:capture>"]
    assert bytes(tricky["response"]["payload"]).decode() == TRICKY
    assert tricky["request"]["fields"] is None and tricky["request"]["target_uri"] == "http://c/"
    assert "payloadBytes: " in tricky["metadata"]["fields"]
    assert whole["<urn:page:4:capture>"]["response"]["target_uri"] == "http://d/  X: y"


def test_records_without_partners(spark):
    rows = spark.createDataFrame(
        [("a", "response", None, "r"), ("b", "request", "a", "r2"), ("c", "metadata", "zz", "r3"), ("d", "revisit", None, "r4"), ("e", "warcinfo", None, None), ("b2", "request", "a", "r5")],
        "record_id string, record_type string, concurrent_to string, target_uri string",
    ).selectExpr(
        "*", "cast(null as string) refers_to", "cast(null as string) date", "cast(null as string) digest", "cast(null as long) payload_bytes",
        "cast(null as string) payload_sha1", "cast(null as string) fields", "cast(null as binary) payload",
    )
    found = {r["record_id"]: r for r in assemble(rows).collect()}
    assert set(found) == {"a", "d"}
    assert found["a"]["request"]["record_id"] == "b" and found["a"]["metadata"] is None and found["d"]["request"] is None


def test_archives_of_others():
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Type: text/html\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    members = gzip.compress(one) + gzip.compress(two)
    assert unzipped(members) == one + two and unzipped(one) == one
    assert [(h["warc-type"], b) for h, b in records(one + two)] == [("warcinfo", b"hello"), ("resource", b"hi")]
    with pytest.raises(ValueError):
        list(records(two[:-6]))


def test_no_rows(spark):
    assert archived_pages(pages(spark, [])).count() == 0
