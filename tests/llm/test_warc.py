import gzip
import hashlib
from collections import Counter

import pytest
from cases import prose
from pyspark.sql import functions as F

from daymark.llm.warc import captured, deduplicated, members, parsed, read_archives, record_bytes, resolved, restored, write_archives

SCHEMA = "page_id long, url string, html string"
LONG = prose(3, 60_000)
ROWS = [
    (5, "http://a.example/x", prose(1, 40)), (3, "http://b.example/y", prose(1, 40)), (9, None, prose(1, 40)),
    (1, "http://c.example/ü b\r\nX-Page-ID: 77", "short"), (2, "", "short"), (4, "u", None), (6, "u", ""), (7, "u", "é" * 50), (8, "u", "é" * 50),
    (10, "u", "x" * 99), (11, "u", "x" * 99), (12, "u", LONG), (13, "u", LONG), (14, "u", "a\r\n\r\nb WARC/1.1\r\n\r\n" * 20),
    (15, "u", prose(5, 30)), (15, "u", prose(5, 30)), (15, "v", prose(6, 30)), (None, "u", prose(1, 40)), (None, "u", prose(7, 40)), (None, None, None),
]


def brute(rows):
    first, out = {}, []
    data = [(i, (h or "").encode()) for i, _, h in rows]
    for i, p in data:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    seen = set()
    for i, p in sorted(data, key=lambda r: (r[0] is None, r[0])):
        copy = len(p) >= 100 and p in seen
        seen.add(p)
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if copy else "response", first.get(p) if copy else None))
    return Counter(out)


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("payload", F.lit("clash")).withColumn("record_id", F.lit(1))


@pytest.mark.parametrize("file_bytes", [1, 3000, 16 << 20])
def test_equals_counting_and_gives_all_payloads_back(spark, tmp_path, file_bytes):
    path = str(tmp_path / "warc")
    write_archives(resolved(captured(pages(spark, ROWS).repartition(3))), path, "2024-01-02T03:04:05Z", file_bytes)
    records = read_archives(spark, path)
    rows = records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, rows)) == brute(ROWS)
    back = restored(records).select("page_id", F.col("payload").cast("string")).collect()
    assert Counter(map(tuple, back)) == Counter((i, h or "") for i, _, h in ROWS)


def test_query_form(spark):
    assert Counter(map(tuple, deduplicated(pages(spark, ROWS)).collect())) == brute(ROWS)


def test_files_are_plain_warc(spark, tmp_path):
    path = tmp_path / "warc"
    write_archives(resolved(captured(pages(spark, ROWS))), str(path), "2024-01-02T03:04:05Z", 2000)
    files = sorted(path.glob("part-*"))
    assert len(files) > 2
    ids, refers = set(), set()
    for file in files:
        raw = gzip.decompress(file.read_bytes())  # any gzip reader takes the members in turn
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        records = [parsed(m) for m in members(memoryview(file.read_bytes())) if m]
        assert b"".join(members(memoryview(file.read_bytes()))) == raw
        for fields, block in records[1:]:
            assert fields["warc-date"] == "2024-01-02T03:04:05Z" and len(block) == int(fields["content-length"])
            assert fields.get("x-page-id") != "77" and "\n" not in fields["warc-target-uri"]
            ids.add(fields["warc-record-id"])
            if fields["warc-type"] == "revisit":
                assert block.endswith(b"\r\n\r\n") and fields["warc-profile"].endswith("identical-payload-digest")
                refers.add(fields["warc-refers-to"])
    assert len(ids) == len(ROWS) and refers < ids


def test_archives_with_revisits_are_resolved_again(spark, tmp_path):
    """Old archives with their revisits, and new pages with older ids and the same payloads."""
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    write_archives(resolved(captured(pages(spark, ROWS))), first)
    new = [(0, "http://z.example", prose(1, 40)), (20, "u", prose(6, 30))]
    both = read_archives(spark, first).unionByName(captured(pages(spark, new)))
    from daymark.llm.store import written

    write_archives(resolved(written(both, "both")), second)
    again = read_archives(spark, second)
    assert Counter(map(tuple, again.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())) == brute(ROWS + new)
    back = restored(again).select("page_id", F.col("payload").cast("string")).collect()
    assert Counter(map(tuple, back)) == Counter((i, h or "") for i, _, h in ROWS + new)


def test_a_revisit_without_its_original_stays(spark):
    record = ("r1", 1, "u", "revisit", 500, "d" * 64, "r0", 0, "v", None)
    from daymark.llm.warc import FIELDS, RECORD

    df = spark.createDataFrame([record], RECORD + ", payload binary")
    assert [tuple(r) for r in resolved(df).select(*FIELDS).collect()] == [record[:-1]]


def test_damage_is_found():
    row = {"record_id": "1", "page_id": 1, "url": "u", "record_type": "response", "payload_bytes": 3, "payload_digest": hashlib.sha256(b"abc").hexdigest(), "refers_id": None, "refers_to": None, "refers_uri": None}
    from daymark.llm.warc import _as_row

    good = record_bytes(row, b"abc", "2024-01-02T03:04:05Z")
    assert _as_row(*parsed(good))[1] == b"abc"
    with pytest.raises(ValueError):
        _as_row(*parsed(good.replace(b"abc", b"abd")))
    with pytest.raises(ValueError):
        parsed(good[:-8])
    with pytest.raises(ValueError):
        list(members(memoryview(gzip.compress(good)[:-9])))


def test_empty_table(spark):
    assert deduplicated(pages(spark, [])).collect() == []


def test_query_equals_its_sql(spark, sf_dir):
    from compare import connect, differences

    from daymark.llm.queries import ORACLES, QUERIES

    name = "op11_revisits"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""
