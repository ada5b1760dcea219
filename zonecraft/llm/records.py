"""Token ids as length-delimited binary records with masked checksums and an offset index.

Record: length (8 bytes), masked CRC-32 of these 8 bytes (4), payload, masked CRC-32 of the payload (4); integers are
little-endian. Payload: one byte for the bytes per id (2 or 4), one byte that is 1 where a document id is given, the
document id (8), then the ids. Beside ``shard-00007.rec`` lies ``shard-00007.idx``: the 8-byte offset of each record,
so that records can be read in any order.

Shards follow each other in ascending document id, NULL ids first, rows of equal id by text. NULL and empty texts are
the end id alone. An empty table has no shards. A task writes under a name of its own and then moves the file, so a
repeated or lost attempt leaves no half file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecraft.llm.common import Stages, map_batches, typed
from zonecraft.llm.tokens import ENCODED, encoder, tokenizer_path
from zonecraft.llm.words import blocks
from zonecraft.operators.running import running_total
from zonecraft.session import new_stage_path

END_ID = 1
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
PAYLOAD = struct.Struct("<BBq")
SHARDS = "shard int, path string, records long, tokens long"


def masked_crc(data: bytes) -> int:
    """A checksum that stays sound where data hold checksums themselves: rotated by 15 bits, plus a constant."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, TAIL.pack(masked_crc(length)), payload, TAIL.pack(masked_crc(payload))))


def read_frame(file) -> bytes | None:
    """The next payload, None at the end; a record that was cut off or changed raises ValueError."""
    head = file.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size:
        raise ValueError("record cut off in its head")
    length, crc = HEAD.unpack(head)
    if crc != masked_crc(head[:8]):
        raise ValueError("length of a record doesn't match its checksum")
    body = file.read(length + TAIL.size)
    if len(body) < length + TAIL.size:
        raise ValueError("record cut off")
    payload = body[:length]
    if TAIL.unpack(body[length:])[0] != masked_crc(payload):
        raise ValueError("payload of a record doesn't match its checksum")
    return payload


def serialize(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return PAYLOAD.pack(width, doc_id is not None, doc_id or 0) + ids


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    width, known, doc_id = PAYLOAD.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=PAYLOAD.size)


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode every text and write the shards below ``folder``, which all machines share; returns the list of shards."""
    path = tokenizer_path(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = encoder(path)
        end = np.array([end_id], coder.kind).tobytes()
        shard = TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder)
        name = f"{base}/shard-{shard:05d}"
        attempt = uuid.uuid4().hex
        files, index, place, tokens = None, [], 0, 0
        for batch in batches:
            if files is None and batch.num_rows:
                store.create_dir(base, recursive=True)
                files = store.open_output_stream(f"{name}.{attempt}.tmp")
            for first, last, words in blocks(batch.column(1), ENCODED):
                flat, bounds, _ = coder.encode_block(words)
                doc_ids = batch.column(0).slice(first, last - first).to_pylist()
                for doc_id, a, b in zip(doc_ids, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    record = frame(serialize(doc_id, flat[a:b].tobytes() + end, coder.width))
                    files.write(record)
                    index.append(place)
                    place += len(record)
                tokens += len(flat) + len(doc_ids)
        if files is None:
            return
        files.close()
        with store.open_output_stream(f"{name}.{attempt}.itmp") as file:
            file.write(np.array(index, "<u8").tobytes())
        store.move(f"{name}.{attempt}.itmp", f"{name}.idx")
        store.move(f"{name}.{attempt}.tmp", f"{name}.rec")
        yield {"shard": [shard], "path": [f"{folder}/shard-{shard:05d}"], "records": [len(index)], "tokens": [tokens]}

    plain = typed(docs, {"doc_id": "long", "text": "string"})
    # Rows without an id, or of one id, may lie in several shards: the hash of the text is part of the order.
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = plain.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    stages = Stages(docs.sparkSession, "records")
    return stages.write(map_batches(ordered, SHARDS, work), "shards")


def read_records(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """Every record of the shards in their order: document, ids before it, number of ids and their CRC-32 (32-bit ids)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from read_shard(row["path"], row["before"])

    placed = running_total(shards, [], ["shard"], "tokens", "before")
    spread = placed.select("shard", "path", "before").repartitionByRange(max(shards.count(), 1), "shard")
    return map_batches(spread, "doc_id long, start long, n_tokens long, ids_crc32 long", work)


def read_shard(path: str, before: int) -> Iterator[dict]:
    store, base = fs.FileSystem.from_uri(path)
    columns: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
    with store.open_input_stream(f"{base}.rec", buffer_size=1 << 20) as file:
        while (payload := read_frame(file)) is not None:
            doc_id, ids = parse(payload)
            for name, value in zip(columns, (doc_id, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                columns[name].append(value)
            before += len(ids)
            if len(columns["doc_id"]) == 1000:
                yield columns
                columns = {name: [] for name in columns}
    yield columns


def read_shuffled(path: str, seed: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """The records of one shard in a random order, by way of its offset index."""
    store, base = fs.FileSystem.from_uri(path)
    with store.open_input_stream(f"{base}.idx") as file:
        offsets = np.frombuffer(file.read(), "<u8")
    with store.open_input_file(f"{base}.rec") as file:
        for offset in np.random.default_rng(seed).permutation(offsets):
            file.seek(int(offset))
            yield parse(read_frame(file))


def record_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write every document, read the files back and describe what they hold."""
    spark = docs.sparkSession
    shards = write_records(docs, new_stage_path(spark, "token-records"), tokenizer)
    return read_records(spark, shards).select("doc_id", "start", "n_tokens", "ids_crc32")
