import hashlib

from pyspark.sql import functions as F

from panelkit.llm import op8_warc as op
from panelkit.llm.common import scratch

from ..conftest import SMALL
from .helpers import same, words

BIG = words(400, 1)
PAGES = [(1, "http://a.example.org/x?q=1#top", BIG), (2, "https://B.example.org/", BIG), (2, "https://B.example.org/", BIG), (3, None, BIG),
         (4, "http://a.example.org/x?q=1", "short"), (5, "http://a.example.org/y", "short"), (6, "", None), (7, "nohost", ""),
         (None, "http://c.example.com:80/p", BIG + "é"), (8, "http://c.example.com/é ß", BIG + "é"), (9, "ftp://z/\r\nX: y", "é" * 600),
         (-5, "http://c.example.com/n", "é" * 600), (None, "http://d.example.com/", words(300, 9)), (None, "http://e.example.com/", words(300, 9)),
         (10, "http://long.example.com/", words(60_000, 4))]


def pages(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("x") for c in ("key", "payload", "digest", "size", "top", "d", "path")})


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_LINES", 2)
    got = op.digest(op.round_trip(pages(spark))).collect()
    assert len(got) == len(PAGES)
    groups = {}
    for p, _, html in PAGES:
        groups.setdefault((html or "").encode(), []).append(p)
    for body, ids in groups.items():
        rows = [r for r in got if r["payload_digest"] == hashlib.sha1(body).hexdigest()]
        assert sorted((r["page_id"] for r in rows), key=repr) == sorted(ids, key=repr) and {r["payload_bytes"] for r in rows} == {len(body)}
        first = [r for r in rows if r["record_type"] == "response"]
        if len(body) < op.REVISIT_BYTES:
            assert len(first) == len(rows)
        else:
            best = max((i for i in ids if i is not None), default=None)
            assert len(first) == 1 and first[0]["page_id"] == best
            assert all(r["refers_to"] == best for r in rows if r["record_type"] == "revisit")
        assert all(r["refers_to"] is None for r in first)


def test_small_table_against_sql(spark):
    same(op.digest(op.round_trip(spark.read.parquet(f"{SMALL}/pages.parquet"))), op.ORACLE, pages=f"{SMALL}/pages.parquet")


def test_urls_and_payloads_come_back(spark):
    got = {(r["page_id"], r["url"], bytes(r["payload"])) for r in op.round_trip(pages(spark)).collect()}
    assert got == {(p, u or "", (h or "").encode()) for p, u, h in PAGES}


def test_lookup_by_url(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_LINES", 2)
    folder = scratch(spark, "test-warc")
    parts = op.write_index(op.write_archives(pages(spark), folder), folder)
    asked = spark.createDataFrame([("http://A.example.org/x?q=1",), ("https://b.example.org/",), ("http://none.example.org/",)], "url string")
    got = sorted((r["url"], r["page_id"], r["record_type"], len(r["payload"])) for r in op.lookup(spark, folder, parts, asked).collect())
    n = len(BIG.encode())
    # page 3 is the response of the group; the pages asked for are replayed through it
    assert got == [("http://A.example.org/x?q=1", 1, "revisit", n), ("http://A.example.org/x?q=1", 4, "response", 5),
                   ("https://b.example.org/", 2, "revisit", n), ("https://b.example.org/", 2, "revisit", n)]


def test_damage_is_noticed(spark):
    data, _ = op.record(1, "http://x", "x)", b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    fields, payload = op.parse(data)
    assert payload == b"abc" and fields["WARC-Type"] == "response"
    try:
        op.parse(data[:-1])
        raise AssertionError("a short record was read")
    except ValueError:
        pass


def test_plan_holds_no_row_number(spark):
    """Two scans of a table may number its rows differently."""
    plan = op.planned(pages(spark))._jdf.queryExecution().toString()
    assert "monotonically_increasing_id" not in plan


def test_repeated_rows_of_a_response(spark):
    rows = [(7, "http://x.example.org/", BIG)] * 5 + [(7, None, BIG), (3, "http://x.example.org/", BIG)]
    got = op.planned(pages(spark, rows)).collect()
    assert sorted((r["page_id"], r["url"] or "") for r in got) == sorted((i, u or "") for i, u, _ in rows)
    assert [bytes(r["payload"]) for r in got if r["top"] is None] == [BIG.encode()]
    assert {(r["top"]["id"], r["top"]["key"]) for r in got if r["top"]} == {(7, "org,example,x)/")}


def test_empty(spark):
    assert op.digest(op.round_trip(pages(spark, []))).count() == 0
