"""WARC records in seekable Zstandard bundles.

Records are grouped into independent frames of about one MiB; a bundle is a run of frames followed by a seek table in a
skippable frame (the public seekable format). Any Zstandard reader can read a bundle from front to back; the table gives
random access to a frame, and the record map gives a record's bundle, frame and offset inside the frame.

Of records with equal payloads of at least ``min_revisit`` bytes, the one with the largest id is a response; the others
are revisits without a payload, which name it. Rows that share that id and payload are all responses, and so are rows
without an id. A null payload is an empty one. Which rows revisit is decided on ids and digests alone; payloads are
shuffled once, by id, and only if a join with the few revisits asks for it. A bundle is written by one task under a name
of its own, and only bundles listed in the committed record map are read, so a repeated task does no harm.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import filesystem, map_rows, stored, write_file
from ledgerlake.session import scratch_path

FRAME_BYTES, BUNDLE_BYTES, TASK_BYTES, LEVEL = 1 << 20, 64 << 20, 16 << 20, 3
# Fixed values of the seekable format: skippable frame magic, seek table magic.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Footer of a bundle from (compressed, plain) frame sizes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(uri: str) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the end of the file."""
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        n, _, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{uri}: no seek table")
        sizes = struct.unpack(f"<{2 * n}I", f.read_at(8 * n, size - 9 - 8 * n))
    out, at = [], 0
    for packed, plain in zip(sizes[::2], sizes[1::2]):
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(f, offset: int, packed: int, plain: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(f.read_at(packed, offset), max_output_size=plain or 1)


def record_bytes(number: int, page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC 1.1 record. A revisit has no block."""
    def urn(x) -> str:
        return f"<urn:page:{'' if x is None else x}>"

    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {urn(page_id)}",
            f"WARC-Date: {DATE}", f"X-Record-Number: {number}",
            "WARC-Target-URI: " + " ".join((url or "").split()), f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {urn(refers_to)}"]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode() + payload + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block, and where the next record begins."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    start = end + 4
    stop = start + int(fields["Content-Length"])
    return fields, data[start:stop], stop + 4


def plan_revisits(payloads: DataFrame, min_revisit: int) -> DataFrame:
    """(id, digest, refers_to) of the rows that revisit, from (id, digest, size)."""
    large = payloads.where((F.col("size") >= min_revisit) & F.col("id").isNotNull())
    shared = large.groupBy("digest").agg(F.max("id").alias("refers_to"), F.min("id").alias("_first"))
    shared = shared.where("_first < refers_to").drop("_first")
    return large.join(shared, "digest").where("id < refers_to").select("id", "digest", "refers_to").distinct()


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
                  min_revisit: int = 1000) -> DataFrame:
    """Write one record per row; returns the record map: id, record_type, refers_to, bundle, frame, offset, size."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).alias("url"),
                        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    revisits = stored(pages.sparkSession, plan_revisits(rows.select("id", "digest", F.octet_length("payload").alias("size")),
                                                        min_revisit), "warc-revisits")
    rows = rows.join(revisits, ["id", "digest"], "left").select("id", "url", "payload", "digest", "refers_to")

    def write(records: Iterator[dict]) -> Iterator[tuple]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        parts: list[bytes] = []
        sizes: list[tuple[int, int]] = []
        frame, members, held = [], [], []

        def close_frame() -> None:
            plain = b"".join(frame)
            parts.append(packer.compress(plain))
            sizes.append((len(parts[-1]), len(plain)))
            frame.clear()

        def close_bundle() -> list[tuple]:
            uri = write_file(folder, "bundle", [*parts, seek_table(sizes)])
            done = [(*m[:3], uri, *m[3:]) for m in members]
            parts.clear(), sizes.clear(), members.clear()
            return done

        number = at = 0
        for r in records:
            data = record_bytes(number, r["id"], r["url"], r["payload"], r["digest"], r["refers_to"])
            members.append((r["id"], "response" if r["refers_to"] is None else "revisit", r["refers_to"], len(parts), at, len(data)))
            frame.append(data)
            at, number = at + len(data), number + 1
            if at >= FRAME_BYTES:
                close_frame()
                at = 0
                if sum(map(len, parts)) >= BUNDLE_BYTES:
                    yield from close_bundle()
        if frame:
            close_frame()
        if members:
            yield from close_bundle()

    return stored(pages.sparkSession, map_rows(
        rows, write, "id long, record_type string, refers_to long, bundle string, frame int, offset long, size long"), "warc-map")


def read_bundles(record_map: DataFrame) -> DataFrame:
    """Read every record of the mapped bundles: id, record_type, refers_to, digest (of the header), block, by frame."""
    def frames(bundles: Iterator[dict]) -> Iterator[tuple]:
        for b in bundles:
            for k, (offset, packed, plain) in enumerate(read_seek_table(b["bundle"])):
                yield b["bundle"], k, offset, packed, plain

    def records(rows: Iterator[dict]) -> Iterator[tuple]:
        def number(urn: str | None):
            text = (urn or "<urn:page:>")[len("<urn:page:"):-1]
            return int(text) if text else None

        for r in rows:
            fs, path = filesystem(r["bundle"])
            with fs.open_input_file(path) as f:
                data = read_frame(f, r["at"], r["packed"], r["plain"])
            at = 0
            while at < len(data):
                fields, block, at = parse_record(data, at)
                yield (number(fields["WARC-Record-ID"]), fields["WARC-Type"], number(fields.get("WARC-Refers-To")),
                       fields["WARC-Payload-Digest"].removeprefix("sha1:"), block)

    listed = map_rows(record_map.select("bundle").distinct(), frames, "bundle string, frame int, at long, packed long, plain long")
    tasks = max(1, (record_map.agg(F.sum("size")).first()[0] or 0) // TASK_BYTES)
    return map_rows(listed.repartition(tasks, F.col("bundle"), F.col("frame")), records,
                    "id long, record_type string, refers_to long, digest string, block binary", flush=64)


def read_record(record: dict) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one row of the record map: one table read, one frame, one slice."""
    offset, packed, plain = read_seek_table(record["bundle"])[record["frame"]]
    fs, path = filesystem(record["bundle"])
    with fs.open_input_file(path) as f:
        return parse_record(read_frame(f, offset, packed, plain), record["offset"])[:2]


def payload_facts(record_map: DataFrame) -> DataFrame:
    """Per record read back: page_id, payload_bytes, payload_digest (both of the full payload, which for a revisit is that
    of the response it names), record_type, refers_to."""
    read = read_bundles(record_map).select(
        "id", "record_type", "refers_to", "digest", F.octet_length("block").cast("long").alias("size"), F.sha1("block").alias("sha1"))
    read = stored(record_map.sparkSession, read, "warc-read")
    full = read.where("record_type = 'response'").select(
        F.col("id").alias("refers_to"), F.col("sha1").alias("digest"), F.col("size").alias("_size")).distinct()
    wanted = read.where("record_type = 'revisit'")
    full = full.join(wanted.select("refers_to", "digest").distinct(), ["refers_to", "digest"], "left_semi")
    facts = [F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = wanted.join(full, ["refers_to", "digest"], "left").withColumns(
        {"payload_bytes": F.col("_size"), "payload_digest": F.col("digest")})
    responses = read.where("record_type = 'response'").withColumns({"payload_bytes": F.col("size"), "payload_digest": F.col("sha1")})
    return responses.select(facts).unionByName(revisits.select(facts))


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write the bundles to the shared folder, read them back, return the facts of every record."""
    return payload_facts(write_bundles(pages, scratch_path(pages.sparkSession, "warc"), **options))
