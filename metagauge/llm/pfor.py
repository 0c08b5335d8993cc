"""Token ids in patched frame-of-reference blocks.

Ids of a document go into blocks of 128. Of each block the minimum is
subtracted; what is left is packed at the bit width that holds a given
percentile of the block, and the values that need more bits stand in an
exception list. An index has the byte at which each block starts, so any block
can be read alone.

A block, little-endian: minimum uint32, bits uint8, values - 1 uint8, exceptions
uint8, pad uint8; packed values as 64-bit words, first value in the lowest
bits; exceptions as position uint8 each, then value above the minimum uint32
each. Packed, an exception's own bits are zero.

Defined results: null ids have null payload and block_starts and 0 tokens;
no ids have an empty payload. Ids are integers from 0 to 2**32 - 1. doc_ids are
integers (ValueError otherwise), or null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spm
from .columns import integer
from .textcore import flat, slices

BLOCK = 128
PERCENTILE = 0.9
HEAD = np.dtype([("least", "<u4"), ("bits", "u1"), ("last", "u1"), ("odd", "u1"), ("pad", "u1")])


def pack_blocks(ids: np.ndarray, offsets: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all blocks in order, byte offsets of the n + 1 documents in them, byte starts of blocks in their document, blocks of each document."""
    sizes = np.diff(offsets)
    blocks = -(-sizes // BLOCK)
    total = int(blocks.sum())
    first_block = np.cumsum(blocks) - blocks
    if not total:
        return np.zeros(0, np.uint8), np.zeros(len(sizes) + 1, np.int64), np.zeros(0, np.int64), blocks
    doc = np.repeat(np.arange(len(sizes)), blocks)
    at = offsets[:-1][doc] + (np.arange(total) - first_block[doc]) * BLOCK
    count = np.minimum(BLOCK, offsets[1:][doc] - at)
    cell = at[:, None] + np.minimum(np.arange(BLOCK), (count - 1)[:, None])  # the last value fills a short block
    v = ids[cell].astype(np.uint32)
    least = v.min(axis=1)
    v -= least[:, None]
    need = np.frexp(v.astype(np.float64))[1].astype(np.uint8)  # bits of each value
    inside = np.arange(BLOCK) < count[:, None]
    hist = np.bincount((np.arange(total)[:, None] * 33 + need)[inside], minlength=total * 33).reshape(total, 33)
    within = np.cumsum(hist, axis=1)
    bits = (within >= np.ceil(percentile * count)[:, None]).argmax(axis=1).astype(np.uint8)
    odd = (need > bits[:, None]) & inside
    n_odd = odd.sum(axis=1)
    n_odd_bytes = n_odd * 5
    packed_words = (bits.astype(np.int64) * count + 63) // 64
    size = HEAD.itemsize + packed_words * 8 + n_odd_bytes
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    head = np.zeros(total, HEAD)
    head["least"], head["bits"], head["last"], head["odd"] = least, bits, count - 1, n_odd
    out[(start[:, None] + np.arange(HEAD.itemsize))] = head.view(np.uint8).reshape(total, -1)
    row, col = np.nonzero(odd)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        base = start[row] + HEAD.itemsize + packed_words[row] * 8
        out[base + nth] = col
        out[(base + n_odd[row] + 4 * nth)[:, None] + np.arange(4)] = v[row, col].astype("<u4").view(np.uint8).reshape(-1, 4)
    v[odd | ~inside] = 0
    for b in np.unique(bits[bits > 0]).tolist():
        mine = np.flatnonzero(bits == b)
        cols = np.ascontiguousarray(v[mine].T.astype(np.uint64))
        words = np.zeros((2 * b + 1, len(mine)), np.uint64)
        for i in range(BLOCK):
            w, s = divmod(i * b, 64)
            words[w] |= cols[i] << np.uint64(s)
            if s + b > 64:
                words[w + 1] |= cols[i] >> np.uint64(64 - s)
        flat = np.ascontiguousarray(words.T).view(np.uint8).reshape(len(mine), -1)
        for n in np.unique(packed_words[mine]).tolist():
            some = packed_words[mine] == n
            out[(start[mine[some]] + HEAD.itemsize)[:, None] + np.arange(8 * n)] = flat[some, : 8 * n]
    ends = np.concatenate((start, [len(out)]))
    doc_at = ends[np.concatenate((first_block, [total]))]
    return out, doc_at, start - doc_at[doc], blocks


def unpack_block(payload: bytes, start: int) -> np.ndarray:
    """The ids of the block that starts at this byte."""
    head = np.frombuffer(payload, HEAD, 1, start)[0]
    bits, n, odd = int(head["bits"]), int(head["last"]) + 1, int(head["odd"])
    at = start + HEAD.itemsize
    n_words = (bits * n + 63) // 64
    out = np.zeros(n, np.uint64)
    if bits:
        words = np.append(np.frombuffer(payload, "<u8", n_words, at), np.uint64(0))
        bit = np.arange(n) * bits
        w, s = bit // 64, (bit % 64).astype(np.uint64)
        out = words[w] >> s
        over = s + np.uint64(bits) > 64
        out[over] |= words[w[over] + 1] << (np.uint64(64) - s[over])
        out &= np.uint64((1 << bits) - 1)
    at += 8 * n_words
    if odd:
        out[np.frombuffer(payload, np.uint8, odd, at)] = np.frombuffer(payload, "<u4", odd, at + odd)
    return (out + np.uint64(head["least"])).astype(np.int64)


def unpack_blocks(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all blocks that start at these bytes, and how many each has: blocks of one width are unpacked together."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = data[start[:, None] + np.arange(HEAD.itemsize)].view(HEAD).ravel()
    count, bits, odd = head["last"].astype(np.int64) + 1, head["bits"].astype(np.int64), head["odd"].astype(np.int64)
    n_words = (bits * count + 63) // 64
    out = np.zeros((len(start), BLOCK), np.uint64)
    for b in np.unique(bits[bits > 0]).tolist():
        mine = np.flatnonzero(bits == b)
        raw = np.zeros((len(mine), 2 * b + 1), np.uint64)
        for n in np.unique(n_words[mine]).tolist():
            some = np.flatnonzero(n_words[mine] == n)
            raw[some, :n] = np.ascontiguousarray(data[(start[mine[some]] + HEAD.itemsize)[:, None] + np.arange(8 * n)]).view("<u8")
        raw = np.ascontiguousarray(raw.T)
        for i in range(BLOCK):
            w, s = divmod(i * b, 64)
            x = raw[w] >> np.uint64(s)
            if s + b > 64:
                x |= raw[w + 1] << np.uint64(64 - s)
            out[mine, i] = x & np.uint64((1 << b) - 1)
    row = np.repeat(np.arange(len(start)), odd)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(odd) - odd, odd)
        base = (start + HEAD.itemsize + 8 * n_words)[row]
        out[row, data[base + nth]] = np.ascontiguousarray(data[(base + odd[row] + 4 * nth)[:, None] + np.arange(4)]).view("<u4").ravel()
    out += head["least"].astype(np.uint64)[:, None]
    return out[np.arange(BLOCK) < count[:, None]].astype(np.int64), count


def unpack(payload: bytes, starts: list[int]) -> np.ndarray:
    return unpack_blocks(np.frombuffer(payload, np.uint8), np.array(starts, np.int64))[0]


def _columns(ids: np.ndarray, offsets: np.ndarray, valid: np.ndarray, percentile: float) -> list[pa.Array]:
    data, at, starts, blocks = pack_blocks(ids, offsets, percentile)
    gone = pa.array(~valid)
    raw = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(blocks))).astype(np.int32)), pa.array(starts.astype(np.int32)), mask=None if valid.all() else gone)
    raw = raw if valid.all() else pa.compute.if_else(pa.array(valid), raw, pa.scalar(None, pa.binary()))
    return [pa.array(np.diff(offsets).astype(np.int32)), raw, lists]


SCHEMA = "doc_id long, n_tokens int, payload binary, block_starts array<int>"


def encode_ids(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", percentile: float = PERCENTILE) -> DataFrame:
    """(doc_id, n_tokens, payload, block_starts) of lists of ids. A null within a list fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                lists = part.column(1)
                counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)).astype(np.int64)
                values = pa.compute.list_flatten(lists)
                if values.null_count:
                    raise ValueError("a list of ids has a null")
                valid = np.asarray(lists.is_valid())
                yield pa.RecordBatch.from_arrays([part.column(0), *_columns(values.to_numpy(), np.concatenate(([0], np.cumsum(counts))), valid, percentile)], ["doc_id", "n_tokens", "payload", "block_starts"])

    return tokens.select(integer(tokens, id_col).alias("doc_id"), F.col(f"`{ids_col}`").cast("array<long>").alias("ids")).mapInArrow(run, SCHEMA)


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: bytes | None = None, percentile: float = PERCENTILE) -> DataFrame:
    """(doc_id, n_tokens, payload, block_starts) of texts, tokenized and packed in one pass."""
    model = model or spm.load()
    spm.Bpe(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = spm.encoder(model)
        for batch in batches:
            for part in slices(batch, "text", spm.SLICE):
                ids, offsets, _, _ = own.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_columns(ids, offsets, np.asarray(part.column("text").is_valid()), percentile)], ["doc_id", "n_tokens", "payload", "block_starts"])

    return docs.select(integer(docs, id_col).alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def decode(packed: DataFrame) -> DataFrame:
    """All columns and ids, in place of a column of that name: exact round trip of payload and block_starts."""

    @F.arrow_udf("array<long>")
    def ids(payload: pa.Array, starts: pa.Array) -> pa.Array:
        data, at = flat(payload)
        lists = starts.combine_chunks() if isinstance(starts, pa.ChunkedArray) else starts
        sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        values, counts = unpack_blocks(data, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(at[:-1], sizes))
        ends = np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(sizes)))]
        known = np.asarray(payload.is_valid()) & np.asarray(lists.is_valid())
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values), mask=None if known.all() else pa.array(~known))

    return packed.withColumn("ids", ids("payload", "block_starts"))


INDEX = "doc_id long, n_tokens int, file string, at long, size int, block_starts array<int>"


def write(packed: DataFrame, folder: str) -> None:
    """Shards of payloads, one for each task, in a folder that all executors share, and under index their index as Parquet.

    A task that is run again writes another shard; the index names those that count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(at, recursive=True)
        task = TaskContext.get()
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        end, parts = 0, []
        with fs.open_output_stream(f"{at}/{name}") as out:
            for batch in batches:
                data, ends = flat(batch.column("payload"))
                out.write(np.ascontiguousarray(data))
                files = pa.array([name] * batch.num_rows, pa.string())
                parts.append([batch.column("doc_id"), batch.column("n_tokens"), files, pa.array(end + ends[:-1]), pa.array(np.diff(ends).astype(np.int32)), batch.column("block_starts")])
                end += int(ends[-1])
        for columns in parts:  # after the shard is whole
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "file", "at", "size", "block_starts"])

    packed.select("doc_id", "n_tokens", "payload", "block_starts").mapInArrow(run, INDEX).write.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, n_tokens, payload, block_starts) as they were written; each row reads its own bytes of a shard."""

    @F.arrow_udf("binary")
    def payload(file: pa.Array, at: pa.Array, size: pa.Array, known: pa.Array) -> pa.Array:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        open_: dict[str, pa.NativeFile] = {}
        out = []
        for f, a, n, k in zip(file.to_pylist(), at.to_pylist(), size.to_pylist(), known.to_pylist()):
            if k and f not in open_:
                open_[f] = fs.open_input_file(f"{root}/{f}")
            out.append(open_[f].read_at(n, a) if k else None)
        return pa.array(out, pa.binary())

    rows = spark.read.schema(INDEX).parquet(f"{folder}/index")
    return rows.select("doc_id", "n_tokens", payload("file", "at", "size", F.col("block_starts").isNotNull()).alias("payload"), "block_starts")
