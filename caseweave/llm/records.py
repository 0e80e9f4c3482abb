"""Token ids in binary record files with an offset index.

A record is framed by its length (unsigned 64 bits), a masked checksum of the
length, the payload, and a masked checksum of the payload, all little-endian.
The payload is a byte that says whether there is an id, the document's id (64
bits, signed) and its token ids in 16 or 32 bits.  Beside each file lies an index
of the byte offsets of its records, for reads in any order.  Checksums are CRC-32,
rotated and shifted by a constant so that checksums of checksums stay sound.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseweave.llm.native import text_bytes, whole_text
from caseweave.llm.tokens import encoder
from caseweave.llm.workers import prepare, tidy
from caseweave.sinks.staging import shared_folder, stage

END_ID = 2
SHARD_BYTES = 16 << 20
#: Pieces remembered per worker: more than elsewhere, as nothing else is held here.
REMEMBERED = 800_000
MASK = 0xA282EAD8  # the usual constant of masked checksums in record files
MANIFEST = "shard int, file string, records bigint, tokens bigint, width int"
_LENGTH, _CRC, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<?q")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _CRC.pack(masked(length)), payload, _CRC.pack(masked(payload))))


def unframe(stream) -> Iterator[bytes]:
    """Payloads of a file; a wrong checksum or a cut file is an error."""
    while head := stream.read(12):
        length = head[:8]
        if len(head) < 12 or _CRC.unpack(head[8:])[0] != masked(length):
            raise ValueError("damaged record length")
        body = stream.read(_LENGTH.unpack(length)[0] + 4)
        payload = body[:-4]
        if len(body) != _LENGTH.unpack(length)[0] + 4 or _CRC.unpack(body[-4:])[0] != masked(payload):
            raise ValueError("damaged record")
        yield payload


def pack_payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    narrow = ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return _HEAD.pack(doc_id is not None, doc_id or 0) + narrow


def unpack_payload(payload: bytes, width: int) -> tuple[int | None, bytes]:
    """The id and the token ids as little-endian unsigned 32-bit integers."""
    known, doc_id = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=_HEAD.size).astype("<u4").tobytes()
    return (doc_id if known else None), ids


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    width: int = 2,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Encode all documents in ascending id order into ``folder``; returns the staged manifest.

    Shards are ranges of ids, about ``shard_bytes`` of table each.  A task
    writes under a name of its own and only names in the manifest count, so a
    task that is lost or runs twice does no harm.  ``width`` is the bytes per
    id; a vocabulary that does not fit is an error.  Null ids come first; rows with
    one id are ordered by their text; null texts are empty.
    """
    prepare(docs.sparkSession)
    shards = max(1, -(-text_bytes(docs, text_col) // shard_bytes))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("body"))
    ordered = rows.repartitionByRange(shards, F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first(), "body"
    )

    @tidy
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}"
        files, path = fs.FileSystem.from_uri(folder)
        coder, end = encoder(tokenizer, REMEMBERED), end_id.to_bytes(4, "little")
        if width == 2 and coder.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary needs more than 16 bits")
        offsets, at, tokens, stream = [], 0, 0, None
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["body"], strict=True):
                if stream is None:
                    files.create_dir(path, recursive=True)
                    stream = files.open_output_stream(f"{path}/{name}.rec", buffer_size=1 << 20)
                ids = coder.encode(text) + end
                data = frame(pack_payload(None if pd.isna(doc_id) else int(doc_id), ids, width))
                stream.write(data)
                offsets.append(at)
                at += len(data)
                tokens += len(ids) // 4
        if stream is not None:
            stream.close()
            with files.open_output_stream(f"{path}/{name}.idx") as index:
                index.write(np.array(offsets, "<u8").tobytes())
            yield pd.DataFrame(
                {"shard": [shard], "file": [name], "records": [len(offsets)], "tokens": [tokens], "width": [width]}
            )

    ids_as_objects = ordered.select(F.col("id").cast("string").alias("id"), "body")  # longs with nulls become floats
    return stage(ids_as_objects.mapInPandas(write, MANIFEST), "record-manifest")


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each
    record, read from the files and checked against their checksums."""
    prepare(spark)
    # One row per file: few, so one task adds them up.
    placed = manifest.withColumn(
        "base", F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")
    ).repartition(max(1, manifest.count()), "file")

    @tidy
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.itertuples(index=False):
                out, at = [], row.base
                with files.open_input_stream(f"{path}/{row.file}.rec", buffer_size=1 << 20) as stream:
                    for payload in unframe(stream):
                        doc_id, ids = unpack_payload(payload, row.width)
                        out.append((doc_id, at, len(ids) // 4, zlib.crc32(ids)))
                        at += len(ids) // 4
                if len(out) != row.records or at - row.base != row.tokens:
                    raise ValueError(f"{row.file} does not hold what the manifest says")
                frame_ = pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield frame_.astype({"doc_id": "Int64"})

    return placed.mapInPandas(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_one(folder: str, file: str, number: int, width: int = 2) -> tuple[int | None, bytes]:
    """One record by its number in a file, through the index."""
    files, path = fs.FileSystem.from_uri(folder)
    with files.open_input_file(f"{path}/{file}.idx") as index:
        index.seek(8 * number)
        (at,) = _LENGTH.unpack(index.read(8))
    with files.open_input_file(f"{path}/{file}.rec") as data:
        data.seek(at)
        return unpack_payload(next(unframe(data)), width)


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all documents to a new folder under the shared one and reads them back."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    manifest = write_records(docs, folder, tokenizer, id_col, text_col)
    return read_records(spark, folder, manifest).withColumnRenamed("doc_id", id_col)
