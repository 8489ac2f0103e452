"""Archives: written, read back, the same bytes however the rows lie."""

import base64
import hashlib

from skyledger.llm import warc
from skyledger.session import scratch_folder

ROWS = [
    (1, "http://a\r\nb", "x"), (2, None, None), (3, "u", ""), (4, "u é", "x"), (None, "u", "x"), (5, "u", "y" * 200_000),
    (5, "u", "z"), (6, "u", "zé漢"), (7, "v", "only"), (7, "v", "only"), (8, "v", "only"),
]


def pages(spark, rows=ROWS):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.selectExpr("*", "'c' as digest", "'c' as size", "'c' as shard", "1 as refers_to")


def expected(rows):
    firsts: dict = {}
    for page, _, html in rows:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    out = []
    for page, _, html in rows:
        data, first = (html or "").encode(), firsts.get(html or "")
        again = first is not None and (page is None or page > first)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    folder = scratch_folder(spark, "warc-test")
    manifest = warc.write_archive(pages(spark), folder, shard_bytes=50_000, roll_bytes=400)
    rows = warc.read_archive(spark, folder).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == expected(ROWS)
    texts = {(p, (h or "").encode()) for p, _, h in ROWS}
    assert all((r.page_id, bytes(r.payload)) in texts for r in rows if r.record_type == "response")
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    files = manifest.collect()
    assert len({f.name for f in files}) == len(files) > 3
    assert sum(f.records - 1 for f in files) == len(ROWS)


def test_same_bytes_for_any_layout(spark):
    manifests = []
    for parts in (1, 5):
        folder = scratch_folder(spark, "warc-test")
        made = warc.write_archive(pages(spark).repartition(parts), folder, shard_bytes=50_000, roll_bytes=400)
        manifests.append(sorted(tuple(r) for r in made.collect()))
    assert manifests[0] == manifests[1]


def test_only_files_of_the_manifest_are_read(spark):
    folder = scratch_folder(spark, "warc-test")
    warc.write_archive(pages(spark), folder)
    with open(f"{folder}/part-99999-00000.warc.gz", "wb") as stray:
        stray.write(b"not an archive")
    assert warc.read_archive(spark, folder).count() == len(ROWS)


def test_least_size_of_a_revisit(spark):
    folder = scratch_folder(spark, "warc-test")
    warc.write_archive(pages(spark), folder, min_bytes=1)
    rows = {r.page_id: r.record_type for r in warc.read_archive(spark, folder).collect()}
    assert rows[3] == "response" and rows[4] == "revisit"


def test_empty(spark):
    folder = scratch_folder(spark, "warc-test")
    assert warc.write_archive(pages(spark).limit(0), folder).count() == 0
    assert warc.read_archive(spark, folder).count() == 0


def test_a_changed_payload_is_noticed():
    import io

    import pytest

    record = warc.record_bytes(1, "u", "response", warc.base32(hashlib.sha1(b"abc").hexdigest()), 3, None, b"abc")
    assert len(list(warc.read_records(io.BytesIO(record)))) == 1
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(record.replace(b"abc", b"abd"))))


def test_many_shards(spark, tmp_path):
    """As many files as shards, numbered without a gap, each with pages of its own range."""
    pages = spark.range(4000).selectExpr("id AS page_id", "'u' AS url", "repeat(md5(cast(id AS string)), 20) AS html")
    manifest = warc.write_archive(pages, str(tmp_path / "warc"), shard_bytes=300_000)
    shards = sorted(r.shard for r in manifest.collect())
    assert shards == list(range(len(shards))) and len(shards) >= 7
    read = warc.read_archive(spark, str(tmp_path / "warc"))
    assert read.count() == 4000 and read.select("page_id").distinct().count() == 4000
