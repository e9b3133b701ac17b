import gzip
import zlib

from merchlens.llm import warc as q


def read_back(spark, rows, folder, **how):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as keep", "2 as digest", "3 as file")
    rough = q.write_archives(q.with_references(pages), f"{folder}/a", **how).persist()
    clean = q.normalise(rough, f"{folder}/a", f"{folder}/b").persist()
    return clean, q.read_archives(clean, f"{folder}/b").collect()


def test_records_and_references(spark, tmp_path):
    rows = [(1, "http://a/é b\n", "x\r\n\r\nWARC/1.1\r\n"), (2, None, None), (3, "u", ""), (4, "u", "x\r\n\r\nWARC/1.1\r\n"), (4, "u", "x\r\n\r\nWARC/1.1\r\n"),
            (None, "w", "zz"), (None, "v", "x\r\n\r\nWARC/1.1\r\n"), (7, "w", "y" * 3_000_000), (8, "w", "é")]
    files, got = read_back(spark, rows, tmp_path, file_bytes=200)
    said = sorted(((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=lambda x: x[:3])
    assert said == [(-1, 2, "response", None), (-1, 15, "revisit", 4), (1, 15, "revisit", 4), (2, 0, "revisit", 3), (3, 0, "response", None),
                    (4, 15, "response", None), (4, 15, "response", None), (7, 3_000_000, "response", None), (8, 2, "response", None)]
    digests = {(r.page_id, r.payload_digest) for r in got}
    for page, _, html in rows:
        assert (page, q.digest_of((html or "").encode())) in digests


def test_members_stand_alone(spark, tmp_path):
    files, _ = read_back(spark, [(i, f"u{i}", f"page {i}") for i in range(20)], tmp_path)
    row = files.first().asDict()
    archive = (tmp_path / "b" / row["file"]).read_bytes()
    for line in (tmp_path / "b" / row["index"]).read_text().splitlines():
        at, size, kind, urn = line.split()
        assert zlib.decompress(archive[int(at) : int(at) + int(size)], q.GZIP).startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode())
        assert urn.startswith("<urn:page:")
    assert gzip.decompress(archive).count(b"WARC/1.1") == row["n_records"]


def test_empty_table(spark, tmp_path):
    assert read_back(spark, [], tmp_path)[1] == []


def test_records_split_anywhere():
    data = b"".join(q.record(i, "u", b"\r\n\r\n" * i, None, False) for i in range(5))
    for size in (1, 3, 7, len(data)):
        found = list(q.records_in(data[i : i + size] for i in range(0, len(data), size)))
        assert b"".join(whole for _, whole in found) == data and len(found) == 5
