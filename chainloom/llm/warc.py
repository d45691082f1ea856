"""WARC archives: write pages as whole-file gzip streams, rewrite each record as its own gzip member, read by offset.

The writer makes archives as a crawler does that compresses a whole file at once. The normaliser inflates each such
stream once, record by record, turns records whose payload another record already holds into revisits, writes every
record as a gzip member of its own and keeps a sidecar index of offsets. The reader seeks to each member by the
sidecar. All archives lie in the shared folder; a task names its files after itself and its attempt, and only files
named in a committed table are read, so lost executors and repeated attempts do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm import scratch

#: Bytes of records after which a task begins its next archive, and bytes inflated at a time.
ARCHIVE_BYTES = 16 << 20
PIECE = 1 << 20
LEVEL = 6
#: Parts that the records of one payload are dealt to.
SALTS = 16


_UNPRINTABLE = re.compile(r"[\x00-\x20\x7f\x85\s]")


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _size(head: bytes) -> int:
    """Length of the block after a record's header lines; only a line that begins with the field's name counts."""
    return next(int(line[15:]) for line in head.split(b"\r\n")[1:] if line[:15].lower() == b"content-length:")


def records_of_stream(source, piece: int = PIECE) -> Iterator[bytes]:
    """Records of a gzip stream that is inflated once from start to end; any number of members may follow another.

    What is held at once is one record and one inflated piece.
    """
    inflate, held = zlib.decompressobj(31), bytearray()
    while True:
        data = source.read(piece)
        if not data:
            break
        while data:
            held += inflate.decompress(data, piece)
            data = inflate.unconsumed_tail
            if inflate.eof:
                data, inflate = inflate.unused_data, zlib.decompressobj(31)
            at = 0
            while True:
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                size = _size(bytes(held[at:end]))
                if len(held) < end + 8 + size:
                    break
                yield bytes(held[at : end + 8 + size])
                at = end + 8 + size
            del held[:at]
    if held:
        raise ValueError("the stream ends inside a record")


def _uri(url: str | None) -> str:
    """A target for one header line: white space and control characters percent-encoded, all else as it is."""
    return _UNPRINTABLE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "")


def write_archives(pages: DataFrame, where: str) -> DataFrame:
    """One record per page in whole-file gzip archives: page_id, archive, number, payload_bytes, payload_digest."""
    scratch.ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base, fs_path = _open(where)
        base.create_dir(fs_path, recursive=True)
        name, file, press, size, at, count = "", None, None, 0, 0, 0

        def close() -> None:
            if file is not None:
                file.write(press.flush())
                file.close()

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                rows = batch.slice(lo, 1000).to_pydict()
                out: dict[str, list] = {k: [] for k in ("page_id", "archive", "number", "payload_bytes", "payload_digest")}
                for page, url, html in zip(rows["page_id"], rows["url"], rows["html"], strict=True):
                    if file is None or size >= ARCHIVE_BYTES:
                        close()
                        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{count}.warc.gz"
                        file, press, size, at, count = base.open_output_stream(f"{fs_path}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0, count + 1
                    payload = (html or "").encode()
                    mark = digest(payload)
                    headers = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{json.dumps(page)}:{name}:{at}>"), ("WARC-Target-URI", _uri(url)), ("Content-Type", "text/html; charset=utf-8"), ("WARC-Payload-Digest", f"sha1:{mark}"), ("X-Page-Id", json.dumps(page)), ("X-Payload-Length", str(len(payload)))]
                    whole = record(headers, payload)
                    file.write(press.compress(whole))
                    for key, value in zip(out, (page, name, at, len(payload), mark), strict=True):
                        out[key].append(value)
                    size, at = size + len(whole), at + 1
                yield pa.RecordBatch.from_pydict(out, schema=arrow)
        close()

    kind = dict(pages.dtypes)["page_id"]
    arrow = pa.schema([("page_id", pa.int32() if kind == "int" else pa.int64()), ("archive", pa.string()), ("number", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, archive string, number bigint, payload_bytes bigint, payload_digest string")


def revisits(manifest: DataFrame, least: int) -> DataFrame:
    """archive, number, refers_to of every record whose payload a record with a larger page_id holds.

    The copies of one payload may be a third of all records: they are dealt to SALTS parts, each of which meets its own
    copy of the payload's response.
    """
    mine = F.struct("page_id", "archive", "number")
    copies = manifest.where(F.col("payload_bytes") >= least)
    first = copies.groupBy("payload_digest").agg(F.max(mine).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = scratch.keep(first.select("payload_digest", "first"), "payloads")
    salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = copies.withColumn("salt", F.pmod(F.xxhash64("archive", "number"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["payload_digest", "salt"]).where(mine != F.col("first")).select("archive", "number", F.col("first.page_id").alias("refers_to"))


def normalise(archives: DataFrame, streams: str, where: str) -> DataFrame:
    """Rewrite archives (archive, numbers, refers) of folder ``streams`` member by member into folder ``where``: archive,
    normalised, sidecar, records, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        (source_fs, source_root), (fs, root) = _open(streams), _open(where)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                refers = dict(zip(row["numbers"] or [], row["refers"] or [], strict=True))
                stem = f"{row['archive'].removesuffix('.warc.gz')}-members-{attempt}"
                offset, lines = 0, []
                with source_fs.open_input_stream(f"{source_root}/{row['archive']}", compression=None) as source, fs.open_output_stream(f"{root}/{stem}.warc.gz", compression=None) as out:
                    for number, raw in enumerate(records_of_stream(source)):
                        if number in refers:
                            headers, _ = parse(raw)
                            headers |= {"WARC-Type": "revisit", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page": json.dumps(refers[number])}
                            del headers["Content-Length"]
                            raw = record(list(headers.items()), b"")
                        press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = press.compress(raw) + press.flush()
                        out.write(member)
                        lines.append(f"{number} {offset} {len(member)}")
                        offset += len(member)
                with fs.open_output_stream(f"{root}/{stem}.idx", compression=None) as out:
                    out.write("\n".join(lines).encode())
                yield pa.RecordBatch.from_pydict({"archive": [row["archive"]], "normalised": [f"{stem}.warc.gz"], "sidecar": [f"{stem}.idx"], "records": [len(lines)], "bytes": [offset]})

    return archives.mapInArrow(run, "archive string, normalised string, sidecar string, records bigint, bytes bigint")


def read_members(files: DataFrame, where: str, kind: str = "bigint", payloads: bool = False) -> DataFrame:
    """Every record of normalised archives, each by its own offset: page_id, payload_bytes, payload_digest, record_type,
    refers_to, and the target URI and payload where asked for. A response's length and digest are taken from its payload."""
    number = pa.int32() if kind == "int" else pa.int64()
    arrow = pa.schema([("page_id", number), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", number), *([("url", pa.string()), ("payload", pa.binary())] if payloads else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(where)
        for batch in batches:
            for file in batch.to_pylist():
                with fs.open_input_stream(f"{root}/{file['sidecar']}", compression=None) as source:
                    index = [list(map(int, line.split())) for line in source.read().decode().split("\n") if line]
                out: list[dict] = []
                with fs.open_input_file(f"{root}/{file['normalised']}") as source:
                    for _, offset, length in index:
                        source.seek(offset)
                        headers, block = parse(zlib.decompress(source.read(length), 31))
                        row = {"page_id": json.loads(headers["X-Page-Id"]), "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": headers["WARC-Type"], "refers_to": None}
                        if row["record_type"] == "revisit":
                            row["refers_to"] = json.loads(headers["X-Refers-To-Page"])
                        else:
                            row |= {"payload_bytes": len(block), "payload_digest": digest(block)}
                        if payloads:
                            row |= {"url": headers["WARC-Target-URI"], "payload": block}
                        out.append(row)
                        if len(out) == 500:
                            yield pa.RecordBatch.from_pylist(out, schema=arrow)
                            out = []
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    columns = f"page_id {kind}, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}" + ", url string, payload binary" * payloads
    return files.mapInArrow(run, columns)


def round_trip(pages: DataFrame, least: int = 0, payloads: bool = False) -> DataFrame:
    """Write all pages as archives, normalise them and read every record back.

    Of records with equal payloads of at least ``least`` bytes the one with the largest page_id stays a response and
    the others become revisits that refer to it; of repeated rows of that page, the last written stays. A null html is
    an empty payload, a null url an empty target, and white space in a url is percent-encoded in its target; a payload of
    any length is one record, held whole by one task, and an archive ends after the record that fills it, so that empty
    payloads fill archives too; a null page_id comes before all others and is returned as null. An
    empty table has no archives and no rows. Further columns of ``pages`` are not read.
    """
    spark = pages.sparkSession
    raw, where = scratch.folder(spark, "warc-streams"), scratch.folder(spark, "warc")
    kind = dict(pages.dtypes)["page_id"]
    manifest = scratch.keep(write_archives(pages, raw), "warc-manifest")
    again = revisits(manifest, least).groupBy("archive").agg(F.collect_list(F.struct("number", "refers_to")).alias("r"))
    again = again.select("archive", F.col("r.number").alias("numbers"), F.col("r.refers_to").alias("refers"))
    archives = manifest.groupBy("archive").agg(F.sum("payload_bytes").alias("size")).join(again, "archive", "left")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    files = scratch.keep(normalise(archives.select("archive", "numbers", "refers").repartition(tasks), raw, where), "warc-index")
    scratch.remove(spark, raw)  # the index is committed: the whole-file streams are no longer needed
    return read_members(files.repartition(tasks), where, kind, payloads)
