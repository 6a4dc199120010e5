from __future__ import annotations

import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from pricepanel.llm import oracle, warc
from pricepanel.tables import BROADCAST_CONF

from .conftest import by_name

PAGE = "page_id long, url string, html string"


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def pages(spark):
    long = "<p>" + "é" * 60 + "</p>"
    rows = [
        (1, "u1", "short"), (2, "u2", "short"), (5, "u5", long), (3, "u3", long), (9, None, long),
        (4, "u4", None), (6, "u6", ""), (7, "bad\r\nurl", "x" * 300_000), (8, "u8", long + "\r\n\r\nWARC/1.1"),
        (3, "u3b", long), (None, "u0", long), (None, "u0", "alone" * 30), (10, "", "y" * 99), (11, "", "y" * 99),
    ]
    return spark.createDataFrame(rows, PAGE).withColumn("payload", F.lit("z"))


@pytest.mark.parametrize("limit", [None, "-1"])
def test_round_trip_matches_sql(spark, as_sql, tmp_path, limit):
    df = pages(spark)
    if limit:
        spark.conf.set(BROADCAST_CONF, limit)
    try:
        read = warc.archive_round_trip(df, f"file://{tmp_path}/a").cache()
        assert read.count() == df.count()
    finally:
        spark.conf.unset(BROADCAST_CONF)
    told = read.drop("url", "payload")
    same_id = "page_id IS NOT NULL"
    sql = f"SELECT * FROM ({oracle.WARC}) WHERE {same_id}"
    assert by_name(told.where(same_id)) == as_sql(sql, pages=df.drop("payload"))
    nameless = {(r["record_type"], r["refers_to"]) for r in read.where("page_id IS NULL").collect()}
    assert nameless == {("revisit", 3), ("response", None)}
    texts = {r["page_id"]: r["html"] or "" for r in df.collect()}
    for r in read.where("record_type = 'response' AND page_id IS NOT NULL").collect():
        assert bytes(r["payload"]).decode() == texts[r["page_id"]]
        assert hashlib.sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"]


def test_single_records_are_read_by_the_index(spark, tmp_path):
    path = f"file://{tmp_path}/b"
    index = warc.write_archives(pages(spark), path, frame_bytes=400, bundle_bytes=2000)
    assert index.select("bundle").distinct().count() > 1
    assert index.agg(F.max("frame")).first()[0] > 0
    one = warc.read_records(warc.read_index(spark, path).where("page_id = 8")).collect()
    assert [bytes(r["payload"]).decode()[-8:] for r in one] == ["WARC/1.1"]


def test_any_zstandard_reader_unpacks_a_bundle():
    out = io.BytesIO()
    writer = warc.BundleWriter(out, frame_bytes=50)
    records = [b"%03d" % k * 7 for k in range(40)]
    places = [writer.add(r) for r in records]
    writer.finish()
    data = out.getvalue()
    assert len(data) == writer.written
    plain = zstandard.ZstdDecompressor().stream_reader(
        io.BytesIO(data), read_across_frames=True
    ).read()
    assert plain == b"".join(records)
    reader = warc.BundleReader(File(data))
    for (frame, offset), record in zip(places, records, strict=True):
        assert reader.frame(frame)[offset : offset + len(record)] == record
    assert len(reader.sizes) == places[-1][0] + 1 > 10


def test_a_file_without_a_seek_table_is_refused():
    with pytest.raises(ValueError, match="seek table"):
        warc.BundleReader(File(zstandard.compress(b"x" * 100)))


def test_large_pages_are_handed_on_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BATCH_BYTES", 250_000)
    df = spark.range(30).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.concat(F.col("id").cast("string"), F.repeat(F.lit("q"), 100_000)).alias("html"),
    )
    read = warc.archive_round_trip(df, f"file://{tmp_path}/d")
    sizes = read.select("page_id", F.octet_length("payload").alias("n"), "payload_bytes").collect()
    assert {r["page_id"] for r in sizes} == set(range(30)) and len(sizes) == 30
    assert all(r["n"] == r["payload_bytes"] == 100_000 + len(str(r["page_id"])) for r in sizes)
    assert "payload" not in warc.read_records(warc.read_index(spark, f"file://{tmp_path}/d"), payload=False).columns


def test_a_damaged_record_is_found(spark, tmp_path):
    path = tmp_path / "e"
    index = warc.write_archives(spark.createDataFrame([(1, "u", "some page " * 30)], PAGE), f"file://{path}")
    (bundle,) = (path / "bundles").iterdir()
    data = bytearray(bundle.read_bytes())
    data[20] ^= 1
    bundle.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged|corrupt|checksum|decompress"):
        warc.read_records(index, payload=False).collect()


def test_no_pages(spark, tmp_path):
    df = pages(spark).where("false")
    assert warc.archive_round_trip(df, f"file://{tmp_path}/c").count() == 0
