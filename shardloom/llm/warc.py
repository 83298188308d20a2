"""WARC archives compressed record by record with a dictionary of their own.

An archive starts with a skippable frame that holds a Zstandard dictionary built from its own records; every
record is a frame of its own that needs this dictionary. Records whose payload was archived before become
revisits of the first one.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import with_few
from shardloom.session import as_written, file_uri, scratch_path

#: Fixed values of the format: magic of the skippable frame with the dictionary, record separators, date.
DICT_MAGIC = 0x184D2A5D
VERSION, END, DATE = b"WARC/1.1", b"\r\n", "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this many bytes are never revisits.
LEAST_BYTES = 100
#: Raw bytes of records per archive, bytes of its dictionary, and bytes of its records the dictionary is built from.
ARCHIVE_BYTES = 16 << 20
DICT_BYTES = 32_768
TRAIN_BYTES = 2 << 20
LEVEL = 3
INDEX = "path string, n_records bigint, raw_bytes bigint, file_bytes bigint"
READ = "id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload string"


def record_bytes(page_id: str | None, url: str | None, payload: bytes | None, size: int, digest: str,
                 refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if refers_to is not None else http + (payload or b"")
    name = lambda x: "<urn:page:" + quote(x, safe="") + ">"
    head = [VERSION.decode(), "WARC-Type: " + ("response" if refers_to is None else "revisit"),
            f"WARC-Record-ID: {name(page_id) if page_id is not None else '<urn:nopage>'}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]~%"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + END + END + block + END + END


def archive_dictionary(records: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A dictionary built from an even choice among the archive's records; their bare ends where they are too few."""
    total = sum(map(len, records))
    chosen = records[:: max(1, total // TRAIN_BYTES)]
    pieces = [r[at:at + 16_384] for r in chosen for at in range(0, len(r), 16_384)]
    try:
        return zstandard.train_dictionary(size, pieces, k=256, d=8, f=18, accel=4).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-size:] or b"WARC/1.1"


def _known(content: bytes) -> zstandard.ZstdCompressionDict:
    kind = zstandard.DICT_TYPE_FULLDICT if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(content, dict_type=kind)


def archive_bytes(records: list[bytes]) -> bytes:
    """The dictionary's frame, then one frame per record."""
    content = archive_dictionary(records)
    words = _known(content)
    words.precompute_compress(level=LEVEL)
    coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=True)
    return b"".join([struct.pack("<II", DICT_MAGIC, len(content)), content, *map(coder.compress, records)])


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive, read as a stream."""
    head = source.read(8)
    magic, size = struct.unpack("<II", head)
    if magic != DICT_MAGIC:
        raise ValueError("the archive has no dictionary frame")
    stream = zstandard.ZstdDecompressor(dict_data=_known(source.read(size))).stream_reader(source, read_across_frames=True)
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = stream.read(max(1 << 16, n - len(held)))
            if not more:
                return False
            held.extend(more)
        return True

    while fill(1):
        while (stop := held.find(END + END)) < 0:
            if not fill(len(held) + 1):
                raise ValueError("a record is cut short")
        lines = held[:stop].decode().split("\r\n")
        if lines[0] != VERSION.decode():
            raise ValueError("a record does not start where the last one ends")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        if not fill(stop + 4 + size + 4):
            raise ValueError("a record is cut short")
        yield headers, bytes(held[stop + 4:stop + 4 + size])
        del held[:stop + 4 + size + 4]


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def _write(folder: str, records: list[bytes]) -> tuple[str, int, int, int]:
    """Write one archive under a name no other attempt uses; what failed attempts leave is in no index."""
    store, base = _place(folder)
    name, data = f"pages-{uuid.uuid4().hex}.warc.zst", archive_bytes(records)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{name}", compression=None) as out:  # not once more for its ending
        out.write(data)
    return f"{folder}/{name}", len(records), sum(map(len, records)), len(data)


def write_archives(records: DataFrame, folder: str, archive_bytes_at_most: int = ARCHIVE_BYTES) -> DataFrame:
    """The index of the archives written: ``path, n_records, raw_bytes, file_bytes``.

    ``records`` has ``id, url, payload, size, digest, refers_to``. Every task writes its rows to archives of about
    ``archive_bytes_at_most`` raw bytes, of which it holds one. The index is itself written, and only archives of
    tasks that ended well are in it.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made = [], 0, []
        for batch in batches:
            for row in zip(*[batch.column(batch.schema.get_field_index(c))
                             for c in ("id", "url", "payload", "size", "digest", "refers_to")]):
                page, url, payload, n, digest, refers = [x.as_py() for x in row]
                held.append(record_bytes(page, url, payload.encode() if payload is not None else None, n, digest, refers))
                size += len(held[-1])
                if size >= archive_bytes_at_most:
                    made.append(_write(folder, held))
                    held, size = [], 0
        if held:
            made.append(_write(folder, held))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=["path", "n_records", "raw_bytes", "file_bytes"])

    return as_written(records.mapInArrow(work, INDEX), "warc-index")


def read_archives(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives of an index, in ``READ`` columns; digests of responses are computed anew.

    A record whose payload does not have the digest its header names is an error, and so is an archive with fewer
    or more records than were written.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = _place(path)
                rows, held, met = [], 0, 0
                with store.open_input_stream(name, compression=None) as source:
                    for headers, block in read_archive(source):
                        rows.append(_row(headers, block, with_payload))
                        held += len(block)
                        met += 1
                        if held > ARCHIVE_BYTES or len(rows) >= 10_000:
                            yield _rows(rows)
                            rows, held = [], 0
                if met != expected:
                    raise ValueError(f"{path}: {met} of {expected} records can be read")
                if rows:
                    yield _rows(rows)

    paths = index.select("path", "n_records")
    return paths.repartition(max(1, index.count()), "path").mapInArrow(work, READ)


def _named(uri: str | None) -> str | None:
    return unquote(uri[len("<urn:page:"):-1]) if uri and uri.startswith("<urn:page:") else None


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} does not have its digest")
    url = headers.get("WARC-Target-URI")
    return (_named(headers["WARC-Record-ID"]), unquote(url) if url is not None else None, size, digest, kind,
            _named(headers.get("WARC-Refers-To")), payload.decode() if with_payload and kind == "response" else None)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    text, long = pa.string(), pa.int64()
    kinds = dict(id=text, url=text, payload_bytes=long, payload_digest=text, record_type=text, refers_to=text, payload=text)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


def archive_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Write one record per row and return the index of the archives.

    Of rows with equal payloads of at least ``least`` bytes, those with the smallest id are responses and the
    others revisit it; all smaller payloads are responses. A null payload is empty; a null id is the smallest only
    where no other has the payload, and then nothing revisits it; rows that repeat an id repeat their record;
    other columns are not read; an empty table gives an empty index. Payloads stay where they are while the
    repeated digests are few; a larger list of them is joined in a shuffle.
    """
    spark: SparkSession = pages.sparkSession
    folder = file_uri(spark, folder or scratch_path(spark, "warc"))
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn(
        "size", F.octet_length("payload").cast("long"))
    firsts = as_written(
        rows.select("digest", "size", "page").filter(F.col("size") >= least).groupBy("digest")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first"), "digests")
    told = with_few(rows, firsts, ["digest"], how="left")
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    return write_archives(told.select(
        "id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", "digest",
        F.when(again, F.col("first").cast("string")).alias("refers_to")), folder)
