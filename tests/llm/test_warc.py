import io
import os

import pytest
import zstandard

from shelfline import session
from shelfline.llm import warc


def archive(records, dictionary=b"", compressed=True):
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    lead = warc.dictionary_frame(dictionary) if dictionary else b""
    c = zstandard.ZstdCompressor(dict_data=d, write_checksum=True)
    return lead + b"".join(c.compress(r) for r in records)


RECORDS = [warc.record_bytes(1, "http://a/\nb", b"<p>one</p>" * 50, None), warc.record_bytes(2, None, b"", None),
           warc.record_bytes(3, "http://c/", b"<p>one</p>" * 50, 1), warc.record_bytes(None, "x", "é".encode(), None)]


@pytest.mark.parametrize("dictionary", [b"", b"<p>one</p> raw content", "trained"])
def test_frames_read_back(dictionary):
    if dictionary == "trained":
        dictionary = warc.archive_dictionary([warc.record_bytes(i, f"http://a/{i}", b"word %d " % (i * 7) * 30, None) for i in range(300)])
        assert dictionary[:4] == b"\x37\xa4\x30\xec"
    got = list(warc.read_records(io.BytesIO(archive(RECORDS, dictionary))))
    assert got == RECORDS
    fields = [warc.parse_record(r) for r in got]
    assert [f["record_type"] for f in fields] == ["response", "response", "revisit", "response"]
    assert [f["payload_bytes"] for f in fields] == [500, 0, 500, 2]
    assert fields[2]["payload_digest"] == fields[0]["payload_digest"] == warc.digest(b"<p>one</p>" * 50)
    assert fields[2]["refers_to"] == fields[0]["record_id"] and fields[0]["target_uri"] == "http://a/%0Ab"


def test_an_uncompressed_dictionary_is_read(tmp_path):
    import struct
    raw = b"<p>one</p> plain dictionary"
    body = struct.pack("<II", warc.SKIPPABLE, len(raw)) + raw + archive(RECORDS, raw)[len(warc.dictionary_frame(raw)):]
    assert list(warc.read_records(io.BytesIO(body))) == RECORDS
    assert list(warc.read_records(io.BytesIO(b""))) == []


def test_broken_archives_and_records_are_errors():
    whole = archive(RECORDS, b"<p>one</p> dictionary")
    for bad in (whole[:-3], whole[:-40] + b"x" * 40):
        with pytest.raises((warc.WarcError, zstandard.ZstdError)):
            list(warc.read_records(io.BytesIO(bad)))
    good = RECORDS[0]
    for bad in (good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"WARC-Type: response\r\n", b""), good[:-1],
                good.replace(b"<p>one", b"<p>two", 1), good.replace(b"WARC-Date:", b"WARC-Date"), good + b"x",
                good.replace(b"Content-Length: 500", b"Content-Length: 501"), b"no header"):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)


def test_pages_go_through_archives(spark, tmp_path):
    rows = [(i, f"http://e/{i}", "same" if i % 3 == 0 else f"page {i} " * (i % 50)) for i in range(300)] + [
        (300, None, None), (301, "u", ""), (302, "v", "x" * 300_000), (302, "v", "x" * 300_000), (None, "w", "same")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, __salt int")
    manifest = warc.write_archives(df, f"{tmp_path}/archives", archive_bytes=4000)
    assert manifest.count() > 3 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
    got = warc.read_archives(manifest, payloads=True).collect()
    assert len(got) == len(rows)
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    by_id = {(i, u): h or "" for i, u, h in rows}
    for r in got:
        text = by_id[r["page_id"], r["target_uri"]]
        first = largest[text] == r["page_id"]
        assert r["record_type"] == ("response" if first else "revisit")
        assert r["refers_to"] == (None if first else largest[text])
        assert (r["payload_bytes"], r["payload_digest"]) == (len(text.encode()), warc.digest(text.encode()))
        assert bytes(r["payload"]) == (text.encode() if first else b"")
    assert warc.read_archives(warc.write_archives(df.where("false"), f"{tmp_path}/none")).collect() == []
    short = manifest.selectExpr("path", "records + 1 AS records")
    with pytest.raises(Exception, match="records, not"):
        warc.read_archives(short).collect()


def test_min_bytes_keeps_small_copies_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(df, f"{tmp_path}/a", min_bytes=3)).collect()
    assert sorted((r["page_id"], r["record_type"]) for r in got) == [
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_archives_are_read_by_many_tasks(spark, tmp_path):
    paths = []
    for i in range(40):
        path = f"{tmp_path}/{i}.warc.zst"
        with open(path, "wb") as f:
            f.write(archive(RECORDS))
        paths.append((path, len(RECORDS)))
    got = warc.read_archives(spark.createDataFrame(paths, "path string, records long"))
    assert got.rdd.getNumPartitions() == 40 and got.count() == 40 * len(RECORDS)


def test_archives_are_dropped_by_release(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string")
    folder = warc.archive_folder(spark)
    assert warc.read_archives(warc.write_archives(pages, folder)).count() == 1
    assert folder in session._written[spark.sparkContext.applicationId]
    # Other tests' tables stay: only this folder is released.
    others = session._written[spark.sparkContext.applicationId]
    session._written[spark.sparkContext.applicationId] = [folder]
    assert session.release(spark) == 1 and not os.path.exists(folder)
    session._written[spark.sparkContext.applicationId] = [p for p in others if p != folder]
