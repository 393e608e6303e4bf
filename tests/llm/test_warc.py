import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from touchledger.llm import warc

PAGES = [(3, "http://a/3", "<p>same</p>", 1), (1, "http://a/1", "<p>same</p>", 2), (2, None, "other é", 3), (7, "http://a/7", None, 4),
         (8, "http://b/\r\nX: y", "", 5), (9, "http://c", "body\r\n\r\nWARC/1.1\r\n\r\n" + "x" * 300_000, 6), (None, "http://n", "<p>same</p>", 7)]


@pytest.fixture(scope="module")
def source(llm):
    warc.register(llm)
    return llm


@pytest.fixture
def archive(source, tmp_path):
    path = str(tmp_path / "warc")
    pages = source.createDataFrame(PAGES, "page_id bigint, url string, html string, sha1 int").repartition(3)
    warc.records_of(pages).write.format("warc").mode("append").option("fileBytes", 2000).save(path)
    return path


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def read(spark, path, schema="", **options):
    reader = spark.read.format("warc").options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def test_round_trip(source, archive):
    rows = read(source, archive, verify="true").withColumns(
        {"page": warc.page_of("record_id"), "to": warc.page_of("refers_to")}).collect()
    got = {r["page"]: (r["record_type"], r["to"], r["payload_digest"], r["payload_bytes"], r["payload"] and bytes(r["payload"]).decode()) for r in rows}
    want = {}
    for page, _, html, _ in PAGES:
        html = html or ""
        first = min(p for p, _, h, _ in PAGES if (h or "") == html and p is not None)
        revisit = page != first
        want[page] = ("revisit" if revisit else "response", first if revisit else None, digest(html), len(html.encode()),
                      None if revisit else html or None)
    got = {k: (*v[:4], v[4] or None) for k, v in got.items()}
    assert got == want and len(rows) == len(PAGES)


def test_least_bytes_keeps_small_copies_as_responses(source, tmp_path):
    pages = source.createDataFrame(PAGES[:4], "page_id bigint, url string, html string, x int")
    kinds = {r["record_id"]: r["refers_to"] for r in warc.records_of(pages, least_bytes=12).collect()}
    assert set(kinds.values()) == {None}


def test_predicates_are_pushed_and_unwanted_payloads_not_decoded(source, archive, monkeypatch):
    frame = read(source, archive).where("record_type = 'revisit'").select("record_id")
    assert sorted(r[0] for r in frame.collect()) == ["urn:x-page:3", "urn:x-page:8", "urn:x-page:none"]
    schema = source.createDataFrame([], warc.SCHEMA).schema
    decoded = []
    peek = warc._Member.peek
    monkeypatch.setattr(warc._Member, "peek", lambda self, at, n: decoded.append(n) or peek(self, at, n))
    from pyspark.sql.datasource import EqualTo, In, IsNotNull, Not, StringStartsWith

    reader = warc.WarcReader(archive, schema, 1 << 20, False)
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), StringStartsWith(("target_uri",), "http://c"),
                                    EqualTo(("payload_bytes",), 3), Not(In(("record_id",), ("urn:x-page:1",))), IsNotNull(("target_uri",))]))
    assert [type(x).__name__ for x in left] == ["EqualTo"] and left[0].attribute == ("payload_bytes",)
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["record_id"] for r in rows] == ["urn:x-page:9"] and len(decoded) == 1


@pytest.mark.parametrize("predicate", ["target_uri is null", "target_uri <> 'http://a/1'", "not (target_uri like 'http://a%')",
                                       "record_id in ('urn:x-page:1', 'urn:x-page:2')", "record_id > 'urn:x-page:3'",
                                       "target_uri <=> null", "record_type = 'revisit' or record_id = 'urn:x-page:1'"])
def test_pushed_predicates_mean_what_sql_says(source, archive, predicate):
    schema = "record_id string, record_type string, target_uri string"
    whole = read(source, archive, schema).collect()
    plain = source.createDataFrame([tuple(r) for r in whole], schema).where(predicate).collect()
    assert sorted(map(tuple, read(source, archive, schema).where(predicate).collect()), key=str) == sorted(map(tuple, plain), key=str)


def test_archives_of_others(source, tmp_path):
    """Plain files and gzip members without lengths, with records that are no responses."""
    def make(kind, body, extra=""):
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{kind}>\r\n{extra}Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\npay\r\n\r\nload" + b"z" * 70_000
    records = [make("warcinfo", b"software: x\r\n"), make("response", http, "Content-Type: application/http; msgtype=response\r\n"),
               make("resource", b"raw bytes")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "c.txt").write_text("not an archive")
    rows = read(source, str(tmp_path)).orderBy("file", "offset").collect()
    for some in (rows[:3], rows[3:]):
        assert [r["record_type"] for r in some] == ["warcinfo", "response", "resource"]
        assert bytes(some[1]["payload"]) == b"pay\r\n\r\nload" + b"z" * 70_000 and bytes(some[2]["payload"]) == b"raw bytes"
    assert read(source, str(tmp_path), "record_type string").where("record_type = 'resource'").count() == 2


def test_several_records_in_one_member(source, tmp_path):
    def make(k, n):
        body = bytes([65 + k]) * n
        return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:{k}>\r\nContent-Length: {n}\r\n\r\n".encode() + body + b"\r\n\r\n"
    sizes = [3, 0, 200_000, 7, 90_000, 1]
    records = [make(k, n) for k, n in enumerate(sizes)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(records[:3])) + warc.member(b"".join(records[3:5])) + gzip.compress(records[5]))
    rows = read(source, str(tmp_path)).orderBy("record_id").collect()
    assert [(r["record_id"], bytes(r["payload"])) for r in rows] == [(f"urn:{k}", bytes([65 + k]) * n) for k, n in enumerate(sizes)]
    assert [r[0] for r in read(source, str(tmp_path), "record_id string").orderBy("record_id").collect()] == [f"urn:{k}" for k in range(6)]
    assert read(source, str(tmp_path)).where("record_id = 'urn:4'").first()["payload_bytes"] == 90_000
    whole = b"".join(records[:3])
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(whole[:-100]))
    with pytest.raises(Exception, match="ends inside a record"):
        read(source, str(tmp_path)).collect()
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(whole + b"WARC/1.0\r\nrest"))
    with pytest.raises(Exception, match="ends inside a record's header"):
        read(source, str(tmp_path)).collect()


def test_members_are_gzip(archive):
    import glob

    raw = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{archive}/*.warc.gz")))
    assert raw.count(b"WARC-Type: response") == 4 and raw.count(b"WARC-Type: revisit") == 3
    assert not glob.glob(f"{archive}/*.inprogress") and len(glob.glob(f"{archive}/*.warc.gz")) >= 2


def test_damaged_payloads_and_files_raise(source, tmp_path):
    row = {"record_id": "urn:1", "payload": b"abc", "sha1": hashlib.sha1(b"xyz").digest()}
    (tmp_path / "a.warc.gz").write_bytes(warc.member(warc.record(row)))
    assert read(source, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="does not have its digest"):
        read(source, str(tmp_path), verify="true").collect()
    cut = warc.member(warc.record({"payload": b"q" * 100_000}))[:60]
    (tmp_path / "a.warc.gz").write_bytes(cut)
    with pytest.raises(Exception, match="cut off"):
        read(source, str(tmp_path)).collect()


def test_partitions_pack_whole_files():
    parts = warc.planned([("a", 10), ("b", 60), ("c", 30), ("d", 5)], 64)
    assert [p.files for p in parts] == [["b"], ["c", "a", "d"]]


def test_empty_tables(source, tmp_path):
    path = str(tmp_path / "none")
    pages = source.createDataFrame([], "page_id bigint, url string, html string")
    warc.records_of(pages).write.format("warc").mode("append").save(path)
    assert read(source, path).count() == 0


def test_a_digest_with_many_pages_is_split_over_tasks(llm, workspace):
    """A third of the pages are one; the settings are small enough for the skew join to see it."""
    small = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    before = {k: llm.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            llm.conf.set(k, v)
        pages = llm.range(0, 6000, 1, 12).selectExpr(
            "id AS page_id", "concat_ws('/', transform(sequence(1, 40), k -> hash(id, k))) AS url",
            "CASE WHEN id % 3 = 0 THEN 'gone' ELSE string(id) END AS html")
        rows = warc.records_of(pages, workspace=workspace).selectExpr("refers_to", "payload", "target_uri", "spark_partition_id() AS task")
        tasks = rows.groupBy("task").agg({"refers_to": "count", "payload": "count", "target_uri": "max"}).collect()
    finally:
        for k, v in before.items():
            llm.conf.unset(k) if v is None else llm.conf.set(k, v)
    revisits = [r["count(refers_to)"] for r in tasks]
    assert sum(revisits) == 1999 and sum(r["count(payload)"] for r in tasks) == 4001
    assert max(revisits) < 1000
