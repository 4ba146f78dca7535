import base64
import hashlib
import io
import random
import struct
from pathlib import Path

import pytest
import zstandard

from cataloom.llm import warc
from cataloom.llm.scratch import Scratch

SCHEMA = "page_id long, url string, html string, payload_bytes int"


def some(n=300):
    rng = random.Random(4)
    pages = [(i, f"http://a.example/{i}?q=\n é", rng.choice(["", None, "<p>same</p>", f"<html>page {i} " + "word " * rng.randint(0, 400) + "P*M\x18\0\0\0\0</html>", "é🙂" * 9]), 1) for i in range(n)]
    return pages + [(None, None, "only", 1), (None, "x", "<p>same</p>", 1), (-5, "x", "é🙂" * 9, 1), (7, "x", "z" * 3_000_000, 1), (400, "x", "twice", 1), (400, "x", "twice", 1)]


def brute_force(rows, least=0):
    out = []
    for page, _, html, _ in rows:
        body = (html or "").encode()
        ids = [p for p, _, h, _ in rows if (h or "").encode() == body]
        newest = max((p for p in ids if p is not None), default=None)
        again = len(body) >= least and page != newest
        out.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", newest if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip_against_brute_force(spark, least):
    rows = some()
    got = warc.archive_round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3), least)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows, least)
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def archives(spark, rows):
    scratch = Scratch(spark, "test")
    warc.write_archives(warc.with_revisits(spark.createDataFrame(rows, SCHEMA).repartition(2), scratch), f"{scratch.root}/a")
    return sorted(Path(scratch.root.removeprefix("file://"), "a").glob("part-*"))


def test_archives_are_plain_zstandard(spark):
    """Any decoder that is given the dictionary reads the whole file; the leading frame holds it."""
    files = [f for f in archives(spark, [(i, "u", f"<html>page {i} {'word ' * 300}</html>", 1) for i in range(3000)]) if f.stat().st_size]
    seen = 0
    for f in files:
        data = f.read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_FRAME
        held = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        plain = zstandard.ZstdDecompressor(dict_data=held).stream_reader(io.BytesIO(data[8 + size :]), read_across_frames=True).read()
        kinds = [m for _, _, m in warc.frames(memoryview(data))]
        assert plain.count(b"WARC/1.1\r\n") == kinds.count(warc.FRAME) and kinds[0] == warc.DICTIONARY_FRAME
        seen += kinds.count(warc.FRAME)
    assert seen == 3000


@pytest.mark.parametrize("spoil, says", [
    (lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1), "Content-Length is"),
    (lambda r: r.replace(b"WARC-Date", b"WARC-Fate", 1), "missing WARC-Date"),
    (lambda r: r.replace(b"WARC/1.1", b"WORK/1.1", 1), "no WARC head"),
    (lambda r: r[:-4], "the block has"),
    (lambda r: r + b"\r\n", "the block has"),
    (lambda r: r.replace(b"<b>", b"<i>"), "digest differs"),
    (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type response", 1), "no field"),
    (lambda r: r.replace(b"WARC-Type: response", b"WARC-Date: response", 1), "comes twice"),
    (lambda r: b"Length: x".join(r.rsplit(b"Length: 8", 1)), "HTTP head is 'x'"),
])
def test_broken_records_are_told(spoil, says):
    payload = b"<b>1</b>"
    good = warc.record("response", 5, "u", warc.sha1_base32(payload), len(payload), payload, None)
    bad = spoil(good)
    if says == "HTTP head is 'x'":
        bad = bad.replace(b"WARC-Block-Digest", b"X-Digest")
    coder = zstandard.ZstdCompressor()
    got = list(warc.records_of("a", memoryview(b"".join(map(coder.compress, (good, bad, good))))))
    assert [r["error"] is None for r in got] == [True, False, True] and says in got[1]["error"] and got[1]["position"] > 0
    assert got[0]["payload"] == payload and got[2]["record_id"] == "<urn:page:5>"


def test_broken_archives_are_told(spark):
    payload = b"<b>1</b>"
    coder = zstandard.ZstdCompressor(write_checksum=True)
    frame = coder.compress(warc.record("response", 5, "u", warc.sha1_base32(payload), len(payload), payload, None))
    for data, n in ((frame + frame[:-3], 2), (frame + b"no frame here", 2), (frame[:20], 1), (frame + b"\0", 2), (b"", 0), (struct.pack("<II", warc.DICTIONARY_FRAME, 3) + b"abc" + frame, 2)):
        got = list(warc.records_of("a", memoryview(data)))
        assert len(got) == n and sum(r["error"] is not None for r in got) == (n > 0)
    spoiled = bytearray(frame)
    spoiled[-1] ^= 1
    assert [r["error"] is None for r in warc.records_of("a", memoryview(bytes(spoiled) + frame))] == [False, True]
    # a compressed dictionary, frames of unknown size, and frames of every header
    samples = [warc.record("response", i, "u", warc.sha1_base32(payload), len(payload), payload, None) for i in range(3000)]
    held = zstandard.train_dictionary(4096, samples)
    body = zstandard.compress(held.as_bytes())
    data = struct.pack("<II", warc.DICTIONARY_FRAME, len(body)) + body
    for i, x in enumerate(samples[:40]):
        c = zstandard.ZstdCompressor(dict_data=held, write_content_size=i % 2 == 0, write_checksum=i % 3 == 0, write_dict_id=i % 5 == 0, level=1 + i % 9)
        data += c.compress(x * 1) if i % 2 == 0 else (lambda o: o.compress(x) + o.flush())(c.compressobj())
    got = list(warc.records_of("a", memoryview(data)))
    assert [r["record_id"] for r in got] == [f"<urn:page:{i}>" for i in range(40)] and not any(r["error"] for r in got)


def test_archives_of_a_folder(spark):
    """Sound, broken and empty files side by side."""
    root = Scratch(spark, "test").root
    folder = Path(root.removeprefix("file://"))
    folder.mkdir(parents=True)
    good = zstandard.compress(warc.record("response", 5, None, warc.sha1_base32(b"x"), 1, b"x", None))
    for name, data in (("a.warc.zst", good * 3), ("b.warc.zst", good + good[:9]), ("c.warc.zst", b"")):
        (folder / name).write_bytes(data)
    got = warc.read_archives(spark, root, "*.warc.zst").select("archive", "position", "payload", "error").collect()
    assert len(got) == 5 and sum(r["error"] is None for r in got) == 4
    assert [(r["archive"][-10:], r["position"]) for r in got if r["error"]] == [("b.warc.zst", len(good))]


def test_digest_is_native(spark):
    rows = [("",), ("é🙂",), ("x" * 100_000,)]
    from pyspark.sql import functions as F

    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(warc.payload_digest(F.col("t").cast("binary"))).collect()]
    assert got == [warc.sha1_base32(t.encode()) for (t,) in rows]
