"""Token ids in compact files: canonical, length-limited Huffman codes in independent blocks.

Code lengths come from the counts of all ids by package-merge, so none is longer than the
limit; codes are canonical, so the lengths alone are the code book. Documents lie in
ascending order of id, cut into blocks of whole documents. A block is read without any
other: it holds its documents' ids, their token counts, and a checkpoint of the bit offset
every ``STRIDE`` tokens. All stretches between checkpoints are decoded side by side, one
look into the decoding table for each token.

The files are Parquet, a row for each block, so that Spark writes them whole or not at all:

- ``blocks``: part, block, first (tokens of the part before the block), doc_ids, counts,
  n_bits, checkpoints (bit offsets), payload (bits, most significant first)
- ``book``: token, bits (length of its code)

Defined results: NULL and empty text have the end id alone. Rows of one id, or without one
(these come first), are kept, in any order among themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.llm.tokens import encoder
from deskmill.session import scratch

#: Longest code in bits; the decoding table has 2**LIMIT entries.
LIMIT = 16
#: Tokens between checkpoints.
STRIDE = 256
#: Bytes of plain ids of a block, about; a longer document is a block of its own.
BLOCK_BYTES = 1 << 19

_PLAIN = "doc_id long, ids binary"
_BLOCKS = "part int, block int, first long, doc_ids array<long>, counts array<long>, n_bits long, checkpoints array<long>, payload binary"
_FOUND = "part int, doc_id long, before long, n_tokens long, ids_crc32 long"


# -- the code ---------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits; 0 for ids that never occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n = len(order)
    # Package-merge: each level holds the coins of the symbols and pairs of the level below.
    levels, below = [], np.zeros(0, np.int64)
    for _ in range(limit):
        pairs = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        by = np.argsort(both, kind="stable")
        levels.append(by)
        below = both[by]
    take = 2 * (n - 1)
    made = np.zeros(n, np.int64)
    for by in reversed(levels):
        chosen = by[:take]
        single = chosen < n
        # The cheapest symbols come first, so those taken are a prefix.
        made[: int(single.sum())] += 1
        take = 2 * int((~single).sum())
    lengths[order] = made
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        sizes = lengths[order].astype(np.int64)
        top = int(sizes[-1])
        # Each code takes a share of the space of all codes; codes begin where shares end.
        shares = np.left_shift(np.int64(1), top - sizes)
        begins = np.cumsum(shares) - shares
        codes[order] = begins >> (top - sizes)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every value of the next bits: the id and the length of its code."""
    top = int(lengths.max()) if len(lengths) else 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    shares = np.left_shift(np.int64(1), top - lengths[order].astype(np.int64))
    ids, bits = np.zeros(1 << top, np.uint32), np.ones(1 << top, np.uint8)
    ids[: shares.sum()] = np.repeat(order, shares)
    bits[: shares.sum()] = np.repeat(lengths[order], shares)
    return ids, bits, top


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, int, np.ndarray]:
    """Payload, number of bits, and bit offsets of every STRIDE-th token."""
    if not len(ids):
        return b"", 0, np.zeros(0, np.int64)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    code = codes[ids].astype(np.uint64)
    word, shift = begins >> 6, 64 - (begins & 63) - size
    out = np.zeros(int(ends[-1] + 63 >> 6), np.uint64)
    inside = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.bitwise_or.reduceat(inside, first)
    over = np.flatnonzero(shift < 0)  # one token at most crosses into each word
    out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
    return out.astype(">u8").tobytes(), int(ends[-1]), begins[::STRIDE]


def decode_bits(payload: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The ``n`` ids of a block."""
    ids, bits, top = table
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at = checkpoints.copy()
    out = np.zeros((STRIDE, len(at)), np.uint32)
    low = np.uint32((1 << top) - 1)
    for step in range(STRIDE):
        if step == n - (len(at) - 1) * STRIDE:  # the last stretch is shorter
            at = at[:-1]
        if not len(at):
            break
        value = ahead[at >> 3] >> (32 - top - (at & 7)).astype(np.uint32) & low
        out[step, : len(at)] = ids[value]
        at = at + bits[value]
    return out.T.ravel()[:n]


# -- Spark ------------------------------------------------------------------------------------


def _plain_type(path: str, end_id: int) -> np.dtype:
    """The narrowest type that holds all ids."""
    return np.dtype("<u2" if max(encoder(path).whole.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _plain_type(path, end_id)
        for batch in arrays.slices(batches, "text"):
            ids, ends = encoder(path).encode(batch.column("text"))
            plain = np.insert(ids, ends[1:], end_id).astype(kind)
            offsets = ((ends + np.arange(len(ends))) * kind.itemsize).astype(np.int32)
            column = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(plain)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], ["doc_id", "ids"])

    return run


def _plain(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after the other, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    counts = np.diff(offsets) // kind.itemsize
    return np.frombuffer(data, kind, int(counts.sum()), int(offsets[0])), counts


def _count(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _plain_type(path, end_id)
        total = np.zeros(0, np.int64)
        for batch in arrays.slices(batches, "ids"):
            ids, _ = _plain(batch.column("ids"), kind)
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], ["token", "n"])

    return run


def _write(path: str, end_id: int, lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, sizes = _plain_type(path, end_id), lengths.value
        codes = canonical(sizes)
        part, block, first = TaskContext.get().partitionId(), 0, 0
        for batch in arrays.slices(batches, "ids", BLOCK_BYTES):
            ids, counts = _plain(batch.column("ids"), kind)
            payload, n_bits, points = encode_bits(ids, codes, sizes)
            row = [[part], [block], [first], [batch.column("doc_id").to_pylist()], [counts], [n_bits], [points], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "block", "first", "doc_ids", "counts", "n_bits", "checkpoints", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names)
            block, first = block + 1, first + len(ids)

    return run


def _read(lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths.value)
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                ids = decode_bits(row["payload"], np.array(row["checkpoints"], np.int64), int(ends[-1]), table).astype("<u4")
                crcs = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends, counts, strict=True)]
                columns = [pa.array([row["part"]] * len(counts), pa.int32()), pa.array(row["doc_ids"], pa.int64())]
                columns += [pa.array(ends - counts + row["first"]), pa.array(counts), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "before", "n_tokens", "ids_crc32"])

    return run


def _book(spark: SparkSession, folder: str) -> np.ndarray:
    """Code lengths by id; as many as the tokenizer has ids."""
    rows = spark.read.parquet(f"{folder}/book").collect()
    lengths = np.zeros(max((r["token"] for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r["token"]] = r["bits"]
    return lengths


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, limit: int = LIMIT) -> None:
    """Write the ids of ``docs(doc_id, text)``, an end id after each document, to ``folder``.

    A text is read and encoded once; its plain ids, which are less than the text, are counted, ordered and coded.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = scratch(spark, "plain-ids")
    docs.mapInArrow(_encode(tokenizer, end_id), _PLAIN).write.option("compression", "zstd").parquet(held)
    plain = spark.read.schema(_PLAIN).parquet(held)
    found = plain.select("ids").mapInArrow(_count(tokenizer, end_id), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["token"] for r in found), default=0) + 1, np.int64)  # bounded by the vocabulary
    for r in found:
        counts[r["token"]] = r["n"]
    lengths = code_lengths(counts, limit)
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "token long, bits int").coalesce(1).write.parquet(f"{folder}/book")
    shared = spark.sparkContext.broadcast(lengths)
    ordered = plain.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(_write(tokenizer, end_id, shared), _BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files."""
    shared = spark.sparkContext.broadcast(_book(spark, folder))
    blocks = spark.read.parquet(f"{folder}/blocks")
    found = blocks.mapInArrow(_read(shared), _FOUND)
    # One row for each part: where it begins among all tokens.
    sizes = blocks.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return found.join(F.broadcast(begins), "part").select("doc_id", (F.col("begin") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, limit: int = LIMIT) -> DataFrame:
    """Write the tokens to the shared folder and read them back."""
    folder = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, end_id, limit)
    return read_tokens(docs.sparkSession, folder)
