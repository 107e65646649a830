import gzip
import random
import zlib

import pytest

from ringcast.llm.warc import (
    archive_round_trip,
    archives_under,
    complete,
    read_archives,
    records_starting_in,
    with_firsts,
    write_archives,
)
from ringcast.session import shared_dir

LONG = "<p>" + "é" * 60 + "</p>"
SCHEMA = "page_id long, url string, html string, digest int, size string"
PAGES = [
    (7, "http://a/é?x=1\n", LONG, 1, "x"),
    (3, None, LONG, 1, "x"),
    (9, "http://b", LONG, 1, None),
    (3, "http://twice", LONG, 1, None),
    (1, "u", "short", None, None),
    (2, "u", "short", None, None),
    (4, "u", None, None, None),
    (5, "u", "", None, None),
    (None, "u", LONG, None, None),
    (6, "u", "x" * 99, None, None),
    (8, "u", "x" * 99, None, None),
    (10, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20000, None, None),
]


def wanted(pages):
    import hashlib

    payloads = [(p, (h or "").encode()) for p, _, h, *_ in pages]
    firsts = {}
    for p, raw in payloads:
        if len(raw) >= 100 and p is not None:
            firsts[raw] = min(p, firsts.get(raw, p))
    out = []
    for p, raw in payloads:
        first = firsts.get(raw)
        other = first is not None and first != p
        out.append((p, len(raw), hashlib.sha256(raw).hexdigest(),
                    "revisit" if other else "response", first if other else None))
    return sorted(out, key=str)


def got(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_round_trip(spark, split):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    assert got(archive_round_trip(pages, split)) == wanted(PAGES)


def test_empty_table(spark):
    assert archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_archives_are_plain_gzip_and_split_at_any_byte(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA).coalesce(1)
    files = write_archives(with_firsts(pages).coalesce(1), str(tmp_path / "w"), max_bytes=1200)
    listed = files.collect()
    assert len(listed) > 1 and sum(f.records for f in listed) == len(PAGES)
    for f in listed:
        with gzip.open(f.path) as raw:
            assert raw.read().count(b"X-Page-Id") >= 1
        whole = [r["offset"] for r in records_starting_in(f.path, 0, f.bytes)]
        assert len(whole) == f.records
        for cut in range(1, f.bytes, 37):
            parts = [*records_starting_in(f.path, 0, cut), *records_starting_in(f.path, cut, f.bytes)]
            assert [r["offset"] for r in parts] == whole
    again = read_archives(archives_under(spark, str(tmp_path / "w")))
    assert got(again) == wanted(PAGES)


def test_false_magic_is_no_record(tmp_path):
    member = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so the magic stays visible
    inner = gzip.compress(b"not a record") + b"\x1f\x8b\x08" + b"junk"
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner
    import hashlib

    digest = hashlib.sha256(inner).hexdigest().encode()
    raw = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:" + digest
           + b"\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
    data = member.compress(raw) + member.flush()
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data * 2)
    for cut in range(1, 2 * len(data)):
        found = [r["offset"] for a, b in ((0, cut), (cut, 2 * len(data)))
                 for r in records_starting_in(str(path), a, b)]
        assert found == [0, len(data)]


def test_changed_payload_is_noticed(tmp_path):
    raw = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:00\r\n"
           b"Content-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabcd\r\n\r\n")
    path = tmp_path / "x.warc.gz"
    path.write_bytes(gzip.compress(raw))
    with pytest.raises(ValueError):
        list(records_starting_in(str(path), 0, 10))


def test_a_very_long_header_is_read(spark):
    """Urls that fill more than a block of the file, hardly compressible ones among them."""
    rng = random.Random(8)
    noise = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=600_000))
    rows = [(1, "http://x/" + "a" * 600_000, "<p>one</p>"), (2, f"http://x/{noise}", "<p>two</p>"), (3, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for split in (1 << 10, 16 << 20):
        got = {r.page_id: r.url for r in archive_round_trip(pages, split).collect()}
        assert got == {k: url for k, url, _ in rows}


def test_a_lost_record_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "h"), (2, "v", "i")], "page_id long, url string, html string")
    folder = f"{shared_dir(spark)}/warc-lost"
    files = write_archives(with_firsts(pages), folder)
    records = read_archives(files)
    assert complete(records, files).count() == 2
    with pytest.raises(ValueError, match="2 records were written, 1 were read"):
        complete(records.where("page_id = 1"), files)
