"""WARC archives in Zstandard: one frame a record, a dictionary in a leading skippable frame.

Archives are written by Spark's text sink, a frame a row, so its commit protocol and any file system
serve; what it puts after a row is an empty skippable frame, which decoders pass over.  They are read as
binary files, an archive a row, by walking the frames' headers.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

#: Fixed values of the formats: magic numbers of frames, the dictionary's frame, and of dictionaries.
FRAME, SKIPPABLE, DICTIONARY_FRAME, DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D, 0xEC30A437
#: After each row of the sink: a skippable frame of no bytes.
BETWEEN = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
DATE = "2026-01-01T00:00:00Z"
DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 16 << 10, 1 << 20, 6
RECORD = "archive string, position long, type string, record_id string, target_uri string, payload_bytes long, payload_digest string, refers_to string, payload binary, error string"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(kind: str, page: int | None, uri: str | None, digest: str, size: int, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone, whose length stays the payload's."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _id(page)), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}")]
    if uri:
        fields.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in uri)))
    if kind == "revisit":
        fields += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", _id(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    named = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{named}\r\n".encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    """Named fields of a head, first line left out; names in lower case."""
    out: dict[str, str] = {}
    for line in head.decode("utf-8").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"no field: {line[:60]!r}")
        if name.lower() in out:
            raise ValueError(f"{name} comes twice")
        out[name.lower()] = value.strip()
    return out


def _length(fields: dict[str, str], where: str) -> int:
    value = fields.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"Content-Length of the {where} is {value[:20]!r}")
    return int(value)


def parse(raw: bytes) -> dict:
    """The fields of one record; raises ValueError where a head, a length or a digest is wrong."""
    end = raw.find(b"\r\n\r\n")
    if end < 0 or not raw.startswith(b"WARC/1."):
        raise ValueError("no WARC head")
    fields = _fields(raw[:end])
    missing = [f for f in REQUIRED if f.lower() not in fields]
    if missing:
        raise ValueError(f"missing {', '.join(missing)}")
    block, length = raw[end + 4 :], _length(fields, "record")
    if len(block) != length + 4 or block[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block has {len(block) - 4}")
    block = block[:length]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError("the block's digest differs")
    out = {"type": fields["warc-type"], "record_id": fields["warc-record-id"], "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to")}
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields.get("content-type", "").startswith("application/http"):
        end = block.find(b"\r\n\r\n")
        if end < 0:
            raise ValueError("no end of the HTTP head")
        size, payload = _length(_fields(block[:end]), "HTTP head"), block[end + 4 :]
        if out["type"] == "revisit":
            if payload:
                raise ValueError("a revisit has a payload")
            if not digest or not out["refers_to"]:
                raise ValueError("a revisit without digest or response")
            return out | {"payload": None, "payload_bytes": size, "payload_digest": digest}
        if len(payload) != size:
            raise ValueError(f"HTTP Content-Length is {size}, the payload has {len(payload)}")
    else:
        payload = block
    own = sha1_base32(payload)
    if digest and digest != own:
        raise ValueError("the payload's digest differs")
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": own}


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its header and those of its blocks, without decoding."""
    if len(data) < at + 5:
        raise ValueError("cut short in a frame's header")
    flags = data[at + 4]
    single = flags >> 5 & 1
    size = (1 if single else 0, 2, 4, 8)[flags >> 6]
    end = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + size
    last = False
    while not last:
        if len(data) < end + 3:
            raise ValueError("cut short in a block's header")
        block = int.from_bytes(data[end : end + 3], "little")
        last, kind = block & 1 == 1, block >> 1 & 3
        if kind == 3:
            raise ValueError("a block of no known kind")
        end += 3 + (1 if kind == 1 else block >> 3)
    end += 4 * (flags >> 2 & 1)
    if end > len(data):
        raise ValueError("cut short in a frame")
    return end


def frames(data: memoryview) -> Iterator[tuple[int, int, int]]:
    """(start, end, magic number) of the frames of an archive."""
    at = 0
    while at < len(data):
        if len(data) < at + 8:
            raise ValueError(f"cut short at {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if magic == FRAME:
            end = frame_end(data, at)
        elif magic & ~0xF == SKIPPABLE:
            end = at + 8 + size
            if end > len(data):
                raise ValueError(f"cut short in the skippable frame at {at}")
        else:
            raise ValueError(f"no frame at {at}")
        yield at, end, magic
        at = end


def dictionary_of(frame: memoryview) -> zstandard.ZstdCompressionDict:
    """The dictionary in a skippable frame, plain or itself compressed."""
    body = bytes(frame[8:])
    if body[:4] == struct.pack("<I", FRAME):
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    if body[:4] != struct.pack("<I", DICTIONARY):
        raise ValueError("no dictionary in the leading frame")
    return zstandard.ZstdCompressionDict(body)


def records_of(name: str, data: memoryview) -> Iterator[dict]:
    """The records of one archive, each from a frame of its own; what can't be read has an ``error``.

    A broken record is one row with its position and the next frame is read; where no next frame can be
    found, the archive ends with a row that says so.
    """
    decoder, walk, end = zstandard.ZstdDecompressor(), frames(data), 0
    while True:
        row = dict.fromkeys(("type", "record_id", "target_uri", "payload_bytes", "payload_digest", "refers_to", "payload", "error"))
        row |= {"archive": name, "position": end}
        try:
            start, end, magic = next(walk, (end, end, None))
            if magic is None:
                return
            if magic != FRAME:
                if start == 0 and magic == DICTIONARY_FRAME:
                    decoder = zstandard.ZstdDecompressor(dict_data=dictionary_of(data[:end]))
                continue
            stream = decoder.decompressobj()
            raw = stream.decompress(bytes(data[start:end]))
            if not stream.eof:
                raise ValueError("the frame does not end")
            row |= parse(raw)
        except (ValueError, zstandard.ZstdError) as e:
            row["error"] = str(e)
        yield row
        if walk.gi_frame is None:  # no next frame to be found
            return


def read_archives(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """A row per record of the archives under ``path``: archive, position, type, record_id, target_uri,
    payload_bytes, payload_digest, refers_to, payload, error.

    Heads, lengths and digests are checked; ``error`` says what is wrong, and is null for sound records.
    A revisit's payload is null, its bytes and digest are those of the payload it stands for.  An archive
    is one row for Spark, so it is held by one task while it is read (2 GB at most); rows come out
    in small batches.  Empty files give nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("archive", pa.string()), ("position", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()), ("error", pa.string()),
        ])
        for b in batches:
            for path, content in zip(b.column("path"), b.column("content")):
                held, size = [], 0
                for row in records_of(path.as_py(), memoryview(content.as_buffer())):
                    held.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(run, RECORD)


def write_archives(records: DataFrame, path: str, date: str = DATE) -> None:
    """Writes an archive for each partition of ``records`` (page_id, url, payload binary, size, type, refers_to).

    Every archive starts with its own dictionary, trained on its first records, about a megabyte of them;
    where these are too few to train on, it has none.  A task that is run again writes the same bytes.
    A task's file is never split, since only its beginning has the dictionary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] | None = []
        size, coder = 0, None
        for b in batches:
            out: list[bytes] = []
            for r in b.to_pylist():
                raw = record(r["type"], r["page_id"], r["url"], r["digest"], r["size"], r["payload"] or b"", r["refers_to"], date)
                if waiting is None:
                    out.append(coder.compress(raw))
                    continue
                waiting.append(raw)
                size += len(raw)
                if size >= SAMPLE_BYTES:
                    coder, first = started(waiting)
                    out += first
                    waiting = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(started(waiting)[1], pa.binary())], ["frame"])

    def started(sample: list[bytes]) -> tuple[zstandard.ZstdCompressor, list[bytes]]:
        first, trained = [], None
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, sample)
            body = trained.as_bytes()
            first.append(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)
        except zstandard.ZstdError:  # too few records to learn from
            pass
        coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True, write_content_size=True)
        return coder, first + [coder.compress(x) for x in sample]

    made = records.select("page_id", "url", "payload", "digest", "size", "type", "refers_to").mapInArrow(run, "frame binary")
    made.select(F.col("frame").cast("string").alias("value")).write.mode("overwrite").option("lineSep", BETWEEN).option("maxRecordsPerFile", 0).text(path)


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column, natively: 20 bytes are 32 letters of 5 bits."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    sha = F.sha1(payload)

    def letter(i: Column) -> Column:
        two = F.conv(F.substring(sha, F.floor(i * 5 / 4).cast("int") + 1, F.lit(2)), 16, 10).cast("int")
        return F.substring(letters, F.call_function("shiftright", two, F.lit(3) - F.pmod(i * 5, F.lit(4))).bitwiseAND(F.lit(31)) + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), "")


def with_revisits(pages: DataFrame, scratch: Scratch, least: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) as records: payload, size, digest, type and refers_to.

    Of equal payloads (by their SHA-256) of ``least`` bytes or more, the one with the largest page_id is
    the response.  A payload that over 1/200 of all pages share is met from a broadcast table, which
    has 200 rows at most; all others by a join on the payload's hash.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    whole = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("body"), F.sha2(payload, 256).alias("key"))
    newest = scratch.save(whole.groupBy("key").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")), "newest")
    total = newest.agg(F.sum("n")).first()[0] or 0
    hot = newest.where(F.col("n") > max(1, total / 200)).select("key", F.col("newest").alias("hot"), F.lit(True).alias("is_hot"))
    met = whole.join(F.broadcast(hot), "key", "left")
    apart = F.when(F.col("is_hot"), F.xxhash64("page_id", F.rand(7)).cast("string")).otherwise(F.col("key"))
    met = met.withColumn("own_key", apart).join(newest.select(F.col("key").alias("own_key"), "newest"), "own_key", "left")
    response = F.when(F.col("is_hot"), F.col("hot")).otherwise(F.col("newest"))
    size = F.octet_length("body").cast("long")
    again = (size >= least) & ~F.col("page_id").eqNullSafe(response)
    return met.select(
        "page_id", "url", F.when(~again, F.col("body")).alias("payload"), size.alias("size"), payload_digest(F.col("body")).alias("digest"),
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("type"), F.when(again, response).alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, as read back from
    archives that are written to the shared folder first; raises where a record is not sound.

    Reads page_id, url, html; other columns are not read.  A null html is empty, a null url is left out, a
    null page_id is the smallest and stays null; rows that repeat the largest page_id of a payload
    are all responses; an empty table gives an empty result.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession, "warc")
    path = f"{scratch.root}/archives"
    write_archives(with_revisits(pages, scratch, least), path)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d*)>$", 1)
    read = read_archives(spark, path, "part-*")
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat_ws(" ", "archive", "position", "error"))).otherwise(F.col("type"))
    as_id = lambda c: F.when(number(c) != "", number(c)).cast("long")
    return read.select(
        as_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", sound.alias("record_type"), as_id(F.col("refers_to")).alias("refers_to")
    )


def op13_warc_zstd(spark, sf_dir: str) -> DataFrame:
    """Contract query over all ``pages``."""
    return archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
