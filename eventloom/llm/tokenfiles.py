"""Token files in patched frame-of-reference blocks.

File format, all numbers little-endian:

====================  ==========================================================================
magic                 4 bytes, ``PFR1``
n_docs, n_ids         unsigned 32 and 64 bits
block_len, n_blocks   unsigned 32 bits each
documents             8-byte ids of all documents, then the number of ids of each (32 bits)
index                 64-bit offset of every block, from the first one
block                 minimum (32 bits), width (8), number of exceptions (16), the packed
                      differences to the minimum, exception places (16 each) and values (32 each)
====================  ==========================================================================

The width of a block is that of its 90th percentile difference. Wider differences are packed as their low bits and
stored whole as exceptions. The last block is filled up with its minimum.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import spans
from eventloom.llm.base import written
from eventloom.llm.tokens import piece_encoder, public_path

BLOCK = 512
PERCENTILE = 90

#: Ids in one file; a longer document makes a longer file.
FILE_IDS = 1_000_000

_HEAD = np.dtype([("magic", "S4"), ("n_docs", "<u4"), ("n_ids", "<u8"), ("block_len", "<u4"), ("n_blocks", "<u4")])
_BLOCK_HEAD = 7


def packed_blocks(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of ``ids`` behind each other, and the offset of each. ``block`` is a multiple of 8, 65,536 at most."""
    n_blocks = -(-len(ids) // block)
    if n_blocks == 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint8)
    rows = np.empty((n_blocks, block), dtype=np.uint32)
    flat = rows.reshape(-1)
    flat[: len(ids)] = ids
    flat[len(ids) :] = ids[(n_blocks - 1) * block :].min()
    least = rows.min(axis=1)
    rows -= least[:, None]
    rank = min(block - 1, -(-block * percentile // 100) - 1)
    width = np.searchsorted(2 ** np.arange(32, dtype=np.uint64), np.partition(rows, rank, axis=1)[:, rank], side="right")
    at_row, at_place = np.nonzero(rows >> np.minimum(width, 31).astype(np.uint32)[:, None] > 0)
    wide = width[at_row] < 32
    at_row, at_place = at_row[wide], at_place[wide]
    n_exceptions = np.bincount(at_row, minlength=n_blocks)
    sizes = _BLOCK_HEAD + block // 8 * width + 6 * n_exceptions
    offsets = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    head = np.empty((n_blocks, _BLOCK_HEAD), dtype=np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4] = width
    head[:, 5:] = n_exceptions.astype("<u2").view(np.uint8).reshape(-1, 2)
    out[offsets[:, None] + np.arange(_BLOCK_HEAD)] = head
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        bits = np.unpackbits(rows[own].astype("<u4").view(np.uint8).reshape(len(own), block, 4), axis=2, bitorder="little")
        packed = np.packbits(bits[:, :, :w].reshape(len(own), block * w), axis=1, bitorder="little")
        out[offsets[own, None] + _BLOCK_HEAD + np.arange(block // 8 * w)] = packed
    if len(at_row):
        turn = np.arange(len(at_row)) - (np.cumsum(n_exceptions) - n_exceptions)[at_row]
        base = offsets[at_row] + _BLOCK_HEAD + block // 8 * width[at_row]
        places = at_place.astype("<u2").view(np.uint8).reshape(-1, 2)
        out[(base + 2 * turn)[:, None] + np.arange(2)] = places
        values = rows[at_row, at_place].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(base + 2 * n_exceptions[at_row] + 4 * turn)[:, None] + np.arange(4)] = values
    return offsets.astype(np.uint64), out


def unpacked_blocks(body: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The ids of the blocks at ``offsets`` of ``body``, one row for each block."""
    offsets = offsets.astype(np.int64)
    head = body[offsets[:, None] + np.arange(_BLOCK_HEAD)]
    least = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0]
    width = head[:, 4].astype(np.int64)
    n_exceptions = np.ascontiguousarray(head[:, 5:]).view("<u2")[:, 0].astype(np.int64)
    rows = np.zeros((len(offsets), block), dtype=np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        packed = body[offsets[own, None] + _BLOCK_HEAD + np.arange(block // 8 * w)]
        bits = np.zeros((len(own), block, 32), dtype=np.uint8)
        bits[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(own), block, w)
        rows[own] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
    total = int(n_exceptions.sum())
    if total:
        at_row = np.repeat(np.arange(len(offsets)), n_exceptions)
        turn = np.arange(total) - (np.cumsum(n_exceptions) - n_exceptions)[at_row]
        base = offsets[at_row] + _BLOCK_HEAD + block // 8 * width[at_row]
        place = body[(base + 2 * turn)[:, None] + np.arange(2)].view("<u2")[:, 0]
        rows[at_row, place] = body[(base + 2 * n_exceptions[at_row] + 4 * turn)[:, None] + np.arange(4)].view("<u4")[:, 0]
    return rows + least[:, None]


def encode_file(ids: np.ndarray, docs: np.ndarray, counts: np.ndarray, block: int = BLOCK) -> bytes:
    """One file with the ids of some documents."""
    offsets, body = packed_blocks(ids, block)
    head = np.array((b"PFR1", len(docs), len(ids), block, len(offsets)), dtype=_HEAD)
    parts = (head, docs.astype("<i8"), counts.astype("<u4"), offsets.astype("<u8"), body)
    return b"".join(x.tobytes() for x in parts)


class TokenFile:
    """Reads a file; only the blocks that are asked for are unpacked."""

    def __init__(self, raw: bytes) -> None:
        head = np.frombuffer(raw, _HEAD, 1)[0]
        if head["magic"] != b"PFR1":
            raise ValueError("not a token file")
        self.n_ids, self.block = int(head["n_ids"]), int(head["block_len"])
        n_docs, n_blocks, at = int(head["n_docs"]), int(head["n_blocks"]), _HEAD.itemsize
        self.docs = np.frombuffer(raw, "<i8", n_docs, at)
        self.counts = np.frombuffer(raw, "<u4", n_docs, at + 8 * n_docs).astype(np.int64)
        self.offsets = np.frombuffer(raw, "<u8", n_blocks, at + 12 * n_docs)
        self.body = np.frombuffer(raw, np.uint8, offset=at + 12 * n_docs + 8 * n_blocks)

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids ``[first, last)`` of the file."""
        last = self.n_ids if last is None else min(last, self.n_ids)
        if last <= first:
            return np.empty(0, dtype=np.uint32)
        low = first // self.block
        rows = unpacked_blocks(self.body, self.offsets[low : -(-last // self.block)], self.block)
        return rows.reshape(-1)[first - low * self.block : last - low * self.block]


_FILES = "part int, before long, n_ids long, first_doc long, last_doc long, file binary"


def write_token_files(
    documents: DataFrame,
    vocabulary: str | None = None,
    document: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """The ids of all texts in token files, in ascending order of the document id, and the table of those files.

    ``vocabulary`` is the path of a ``tokenizers`` file (by default the public byte-level vocabulary of 50,257
    ids) that every executor can open. ``end_id`` is appended to each document. One range exchange
    puts the texts in order; each task encodes its range and cuts it into files of about ``file_ids`` ids. The files
    are rows of a Parquet table in the shared folder, so they can lie in any store that Spark writes to:
    ``part`` and ``before`` (ids of the same part before the file) give the order, then number of ids, first and last
    document, and the bytes of the file.

    Defined cases: a null text is empty and has the end id only; a null document id sorts first and is stored as
    the smallest 64-bit number; rows with one id are ordered by the hash of their text, and equal rows keep all
    their copies; an empty table makes no file; other columns are not read.
    """
    path = vocabulary or public_path("byte_bpe_50k.json")
    rows = documents.select(F.col(document).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.withColumn("doc", F.coalesce("doc", F.lit(NULL_ID))).repartitionByRange("doc")
    ordered = ordered.sortWithinPartitions("doc", F.xxhash64("text"), "text").withColumn("part", F.spark_partition_id())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        before, part = 0, 0
        ids: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def file() -> pa.RecordBatch:
            nonlocal before
            all_ids, all_docs = np.concatenate(ids), np.concatenate(docs)
            raw = encode_file(all_ids, all_docs, np.concatenate(counts))
            values = (part, before, len(all_ids), int(all_docs[0]), int(all_docs[-1]), raw)
            before += len(all_ids)
            for kept in (ids, docs, counts):
                kept.clear()
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["part", "before", "n_ids", "first_doc", "last_doc", "file"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        # No block has many more ids than a file.
        for batch, buf, starts in spans.blocks(batches, limit=min(spans.BLOCK_BYTES, 4 * file_ids)):
            part = batch.column("part")[0].as_py()
            plain, number = encoder(buf, starts)
            with_end = np.insert(plain, np.cumsum(number), np.uint32(end_id))
            ids.append(with_end)
            docs.append(batch.column("doc").to_numpy())
            counts.append(number + 1)
            if sum(map(len, ids)) >= file_ids:
                yield file()
        if ids:
            yield file()

    return written(ordered.mapInArrow(encode, _FILES))


#: Stored in place of a null document id.
NULL_ID = -(2**63)


def read_token_files(files: DataFrame) -> DataFrame:
    """Every document of the token files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``
    and ``ids_crc32`` of its ids as little-endian unsigned 32-bit numbers.

    The start of a part is the sum of the parts before it: one number for each partition that wrote files goes to the driver
    and back, as a broadcast of that size.
    """
    spark = files.sparkSession
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    begins, before = [], 0
    for row in totals:
        begins.append((row.part, before))
        before += row.n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, begin, raw in zip(*[batch.column(c).to_pylist() for c in ("part", "before", "file")], strict=True):
                file = TokenFile(raw)
                ids = file.ids().astype("<u4")
                ends = np.cumsum(file.counts)
                crc = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends, file.counts, strict=True)]
                columns = [np.full(len(ends), part, dtype=np.int32), file.docs, begin + ends - file.counts, file.counts]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(crc, pa.int64())],
                    names=["part", "doc", "start", "n_tokens", "ids_crc32"],
                )

    read = files.select("part", "before", "file").mapInArrow(
        decode, "part int, doc long, start long, n_tokens long, ids_crc32 long"
    )
    bases = spark.createDataFrame(begins, "part int, base long")
    return read.join(F.broadcast(bases), "part").select(
        F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"),
        (F.col("base") + F.col("start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
