"""Archives: exact round trip, revisits, damage is found, other readers agree."""

import base64
import gzip
import hashlib
import io

import pytest

from catalograph.llm import warc as W


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAYLOADS = [b"", b"x", "é日本\U0001F600".encode(), b"\r\n\r\n", b"WARC/1.1\r\n\r\n" * 3, b"a" * 300_000, bytes(range(256)) * 2000]


def archive():
    return b"".join(W.record(i, f"http://e.org/{i}?q=a b\r\nX: y", p, None, False) for i, p in enumerate(PAYLOADS)) + \
        W.record(99, None, PAYLOADS[5], 5, True)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_round_trip(monkeypatch, chunk):
    monkeypatch.setattr(W, "CHUNK", chunk)
    data = archive() if chunk > 1 else W.record(0, "http://e.org", PAYLOADS[2], None, False) + W.record(1, "u", b"", None, False)
    found = list(W.read_records(io.BytesIO(data)))
    assert len(found) == (len(PAYLOADS) + 1 if chunk > 1 else 2)
    if chunk > 1:
        assert [r.payload for r in found[:-1]] == PAYLOADS
        assert [r.payload_digest for r in found] == [digest(p) for p in PAYLOADS] + [digest(PAYLOADS[5])]
        last = found[-1]
        assert last.payload is None and last.payload_bytes == 300_000 and last.fields["warc-type"] == "revisit"
        assert last.fields["warc-refers-to"] == found[5].fields["warc-record-id"]
        assert all("x" not in r.fields for r in found)
    for r in found:  # every record is a gzip file of its own
        assert zlib_member(data[r.offset:]).startswith(b"WARC/1.1\r\n")


def zlib_member(data):
    import zlib
    return zlib.decompressobj(31).decompress(data)


def test_other_readers_see_one_stream():
    assert gzip.decompress(archive()).count(b"WARC-Type: ") == len(PAYLOADS) + 1
    assert list(W.read_records(io.BytesIO(b""))) == []
    assert [r.payload for r in W.read_records(io.BytesIO(archive()), keep_payload=False)] == [None] * (len(PAYLOADS) + 1)


def test_damage_is_found():
    good = W.record(1, "http://e.org", b"some payload " * 50, None, False)
    plain = gzip.decompress(good)
    bad = [good[:-9], good[:40], good + b"junk", gzip.compress(plain.replace(b"some payload", b"sane payload")),
           gzip.compress(plain[:-1]), gzip.compress(plain + b"x"), gzip.compress(plain.replace(b"WARC/1.1", b"NOPE/1.1")),
           gzip.compress(plain.replace(b"Content-Length: 7", b"Content-Length: 6"))]
    flipped = bytearray(good)
    flipped[len(good) // 2] ^= 1
    for data in (*bad, bytes(flipped)):
        with pytest.raises(W.CorruptArchive):
            list(W.read_records(io.BytesIO(data)))


def pages():
    same = "<p>same</p>" * 3
    return [(i, f"u{i}", f"<p>{i}</p>" * i) for i in range(2, 30)] + [
        (50, "u", same), (40, "u", same), (45, None, same), (40, "u", same), (60, "v", None), (61, "v", ""), (None, "v", same),
        (None, "w", "only without id"), (70, "é\n", "<html>" + "ü" * 200_000), (71, "z", "<p>2</p>" * 2)]


@pytest.mark.parametrize("least", [0, 12])
def test_tables(spark, tmp_path, least):
    given = pages()
    frame = spark.createDataFrame(given, "page_id long, url string, html string")
    for name in ("payload", "page", "first", "hash", "revisit", "archive"):
        frame = frame.selectExpr("*", f"'clash' as `{name}`")
    manifest = W.write_archives(frame.repartition(3), str(tmp_path / "w"), least, archive_bytes=400)
    assert manifest.count() > 3 and manifest.selectExpr("sum(records)").first()[0] == len(given)
    first = {}
    for i, _, h in given:
        h = h or ""
        if len(h.encode()) >= least and i is not None:
            first[h] = min(first.get(h, i), i)
    expected = []
    for i, _, h in given:
        data = (h or "").encode()
        up = first.get(h or "", i)
        expected.append((i, len(data), digest(data), "response" if up == i else "revisit", None if up == i else up))
    got = W.read_archives(manifest, with_payload=True).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(rows, key=key) == sorted(expected, key=key)
    texts = {(i, h or "") for i, _, h in given}
    assert all((r.page_id, r.payload.decode()) in texts for r in got if r.record_type == "response")


def test_record_ids_are_unique_and_name_the_response(spark, tmp_path):
    given = pages() + [(None, "w", "only without id"), (None, "x", "another without id"), (60, "v", "other payload")]
    frame = spark.createDataFrame(given, "page_id long, url string, html string").repartition(3)
    fields = []
    for row in W.write_archives(frame, str(tmp_path / "w")).collect():
        with open(row.archive.removeprefix("file:"), "rb") as stream:
            fields += [r.fields for r in W.read_records(stream)]
    ids = [f["warc-record-id"] for f in fields]
    assert len(ids) == len(given) == len(set(ids))
    responses = {f["warc-record-id"]: f for f in fields if f["warc-type"] == "response"}
    revisits = [f for f in fields if f["warc-type"] == "revisit"]
    named = [f for f in revisits if "warc-refers-to" in f]
    assert named and all(responses[f["warc-refers-to"]]["page-id"] == f["refers-to-page-id"] for f in named)
    assert all(responses[f["warc-refers-to"]]["warc-payload-digest"] == f["warc-payload-digest"] for f in named)
    # two rows of page 40 are the response of one payload: its revisits name the page only
    assert {f["refers-to-page-id"] for f in revisits if "warc-refers-to" not in f} == {"40"}


def test_empty(spark, tmp_path):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.read_archives(W.write_archives(frame, str(tmp_path / "w"))).collect() == []
