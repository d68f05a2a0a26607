import hashlib
import random

import pytest

from tillstream.llm import warc


def pages(spark, rows, extra="_digest"):
    full = [(k, u, h, "x", "x") for k, u, h in rows]
    return spark.createDataFrame(full, f"page_id long, url string, html string, {extra} string, _payload string")


ROWS = [
    (1, "https://a.example/1", "<p>é</p>" * 40),
    (2, None, "<p>é</p>" * 40),
    (3, "https://a.example/with\r\nbreak", None),
    (4, "", ""),
    (5, "u", "short copy"),
    (6, "u", "short copy"),
    (7, "u", "x" * 100),
    (8, "u", "x" * 100),
    (9, "u", "x" * 99),
    (10, "u", "x" * 99),
    (7, "u", "x" * 100),  # repeats the smallest id
    (8, "u", "x" * 100),
    (None, "u", "x" * 100),
    (None, "u", "no other page has this payload " * 9),
    (None, "u", "no other page has this payload " * 9),
    (11, "u", "".join(random.Random(1).choices("abc \n\r€", k=300_000))),
    (12, "u", "WARC/1.1\r\n\r\n" * 30),
]


def plain(rows):
    first = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 100 and page is not None:
            first[payload] = min(page, first.get(payload, page))
    found = []
    for page, url, html in rows:
        payload = (html or "").encode()
        refers = first.get(payload)
        revisit = refers is not None and refers != page
        found.append(
            (
                page,
                len(payload),
                hashlib.sha256(payload).hexdigest(),
                "revisit" if revisit else "response",
                refers if revisit else None,
                None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"),
                None if revisit else payload,
            )
        )
    return found


def rows_of(df):
    return sorted(
        [
            (
                r.page_id,
                r.payload_bytes,
                r.payload_digest,
                r.record_type,
                r.refers_to,
                r.url,
                None if r.payload is None else bytes(r.payload),
            )
            for r in df.collect()
        ],
        key=repr,
    )


def test_round_trip(spark, tmp_path):
    got = warc.archive_pages(pages(spark, ROWS).repartition(3), f"file://{tmp_path}/w")
    assert rows_of(got) == sorted(plain(ROWS), key=repr)


def test_files_open_with_any_reader(spark, tmp_path):
    """A skippable dictionary frame, then a Zstandard frame per record."""
    records = warc.mark_revisits(pages(spark, ROWS))
    manifest = warc.write_archives(records.coalesce(1), str(tmp_path / "w"), archive_size=1000)
    files = sorted((tmp_path / "w").iterdir())
    assert sum(r.records for r in manifest.collect()) == len(ROWS) and len(files) > 3
    for file in files:
        data = file.read_bytes()
        assert data[:4] == bytes.fromhex("5d2a4d18")
        for record in warc.archive_records(data):
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


def test_files_of_failed_attempts_are_not_read(spark, tmp_path):
    manifest = warc.write_archives(warc.mark_revisits(pages(spark, ROWS)), str(tmp_path / "w"))
    (tmp_path / "w" / "part-000000-999999-0000.warc.zst").write_bytes(b"half a file")
    assert warc.read_archives(manifest).count() == len(ROWS)


def test_trained_dictionary_shrinks_small_records():
    rng = random.Random(2)
    records = [
        warc.record_bytes(str(k), f"https://h{k}.example/", f"<html><body class='page'>{rng.random()}".encode(), "0" * 64, None)
        for k in range(2000)
    ]
    alone = sum(len(warc.zstandard.ZstdCompressor().compress(r)) for r in records)
    archive = warc.archive_bytes(records)
    assert list(warc.archive_records(archive)) == records
    assert len(archive) < 0.6 * alone


def test_damage_is_noticed():
    record = warc.record_bytes("1", "u", b"payload", "0" * 64, None)
    with pytest.raises(ValueError, match="differs"):
        warc.parse_record(record)
    archive = warc.archive_bytes([record])
    with pytest.raises(ValueError, match="ends within"):
        list(warc.archive_records(archive[:-3]))


def test_empty_table(spark, tmp_path):
    assert warc.archive_pages(pages(spark, []), str(tmp_path / "w")).count() == 0


def headers(record):
    lines = record.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:]
    return dict(line.decode().split(": ", 1) for line in lines)


def test_every_revisit_names_its_response(spark, tmp_path):
    rows = [(k, f"u{k}", "same page " * 20 if k % 2 else f"page {k} " * 20) for k in range(20)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    warc.write_archives(warc.mark_revisits(made), str(tmp_path)).count()
    found = [
        headers(record)
        for file in tmp_path.glob("*.warc.zst")
        for record in warc.archive_records(file.read_bytes())
    ]
    by_id = {h["WARC-Record-ID"]: h for h in found}
    revisits = [h for h in found if h["WARC-Type"] == "revisit"]
    assert len(by_id) == 20 and len(revisits) == 9
    for revisit in revisits:
        response = by_id[revisit["WARC-Refers-To"]]
        assert response["WARC-Type"] == "response" and response["X-Page-ID"] == "1"
        assert response["WARC-Payload-Digest"] == revisit["WARC-Payload-Digest"]
    assert all(h["Content-Type"] == "text/html" for h in found if h["WARC-Type"] == "response")
