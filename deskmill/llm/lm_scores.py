"""Cross-entropy difference: how much better a target model expects a text than a background model.

Two bigram models with one vocabulary, one smoothing and one order: the target's from the
documents labelled good, the background's from all documents, with its counts scaled to
as many tokens as the target has. A document's score is the mean over its tokens of the
target's loss less the background's; the lower, the more like the target.

Words and word pairs are told apart by 64-bit hashes and all are counted: both models grow
with the corpus and are never in one place. Texts are packed into chunks. Each chunk
sends its distinct words and pairs, combined, to ranges of the hash; a range adds up what
all chunks sent and sends each chunk the sums it asked for; a chunk then scores its own
documents. A word or pair that is everywhere costs its range one entry a chunk.

Defined results: NULL and empty text has no tokens and score 0; a label counts once however
often it is repeated; with no target document both models are the same and all scores 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.session import materialized

#: Weight of the pair's chance against the word's, and what is added to each word's count.
PAIR_WEIGHT, ADDED = 0.6, 0.5
#: Bytes of text of a chunk; one text stays whole.
CHUNK_BYTES = 4 << 20
#: Ranges of the hash at least (a power of two), and tokens of the corpus for each.
RANGES, RANGE_TOKENS = 1024, 1 << 21

#: How hard texts are compressed, which are shuffled twice.
LEVEL = 9

_WORDS, _PAIRS = 0, 1

_CHUNKS = "chunk long, ids array<long>, n_tokens long, texts binary"
_SENT = "range int, kind int, chunk long, entries binary"
_SUMS = "range int, kind int, chunk long, sums binary, n_distinct long, target long, every long"
_RESULT = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words, of the word before each (0 at a text's begin) and of the pair, and where each text's begin."""
    data, offsets = arrays.utf8(texts)
    data = arrays.LOWER[data]
    starts, stops, first = arrays.spans(data, offsets, arrays.BLANK)
    hashes = np.zeros(len(starts), np.uint64)
    cuts = np.searchsorted(stops, np.arange(0, len(data) + arrays.SLICE_BYTES, arrays.SLICE_BYTES))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        hashes[a:b] = arrays.span_hashes(data, starts[a:b], stops[a:b])
    hashes[cuts[-1] :] = arrays.span_hashes(data, starts[cuts[-1] :], stops[cuts[-1] :])
    before = np.zeros_like(hashes)
    before[1:] = hashes[:-1]
    before[first[:-1][first[:-1] < len(hashes)]] = 0
    return hashes, before, arrays.mixed(before * np.uint64(0x9FB21C651E98DF25) + hashes), first


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length, compressed byte plane by byte plane."""
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(columns, 8, -1).transpose(0, 2, 1)).view(np.uint64)[:, :, 0]


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the order that sorts all, and where each distinct one begins in it."""
    order = np.argsort(values)
    ordered = values[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), ordered[1:] != ordered[:-1]]))
    return ordered[starts], order, starts


def added(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[order], starts) if len(starts) else np.zeros(0, values.dtype)


def spots(order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every value, the number of its distinct one."""
    marks = np.zeros(len(order), np.int64)
    marks[starts] = 1
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(marks) - 1
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 32
    codec = pa.Codec("zstd", LEVEL)
    for batch in arrays.slices(batches, "text", CHUNK_BYTES):
        data, offsets = arrays.utf8(batch.column("text"))
        starts, _, _ = arrays.spans(data, offsets, arrays.BLANK)
        texts = np.diff(offsets).tobytes() + data.tobytes()
        texts = len(texts).to_bytes(8, "little") + codec.compress(texts, asbytes=True)
        made = [pa.array([chunk]), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([len(starts)]), pa.array([texts], pa.binary())]
        yield pa.RecordBatch.from_arrays(made, ["chunk", "ids", "n_tokens", "texts"])
        chunk += 1


def _texts(rows: int, data: bytes) -> pa.Array:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    offsets = np.zeros(rows + 1, np.int64)
    np.cumsum(np.frombuffer(raw, np.int64, rows), out=offsets[1:])
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[8 * rows :]))


def _cuts(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins among sorted hashes."""
    shift = np.uint64(64 - (ranges.bit_length() - 1))
    return np.searchsorted(hashes, np.arange(ranges, dtype=np.uint64) << shift).tolist() + [len(hashes)]


def _send(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("chunk", "rows", "texts", "good")}
                words, _, pairs, first = tokens(_texts(row["rows"], row["texts"]))
                good = np.zeros(row["rows"], np.uint64)
                good[row["good"] or []] = 1
                good = np.repeat(good, np.diff(first))
                for kind, hashes in ((_WORDS, words), (_PAIRS, pairs)):
                    keys, order, starts = distinct(hashes)
                    every = np.diff(starts, append=len(hashes)).astype(np.uint64)
                    target = added(good, order, starts)
                    cuts = _cuts(keys, ranges)
                    filled = [r for r in range(ranges) if cuts[r] < cuts[r + 1]]
                    sent = []
                    for r in filled:
                        own = slice(cuts[r], cuts[r + 1])
                        sent.append(packed(np.diff(keys[own], prepend=np.uint64(0)), target[own], every[own]))
                    made = [pa.array(filled, pa.int32()), pa.array([kind] * len(sent), pa.int32()), pa.array([row["chunk"]] * len(sent), pa.int64()), pa.array(sent, pa.binary())]
                    yield pa.RecordBatch.from_arrays(made, ["range", "kind", "chunk", "entries"])

    return run


def _add(table: pa.Table) -> pa.Table:
    """What all chunks sent to a range and kind, added up, for each chunk in the order it sent."""
    parts = [unpacked(e.as_py(), 3) for e in table.column("entries")]
    keys, order, starts = distinct(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]))
    sums = [added(np.concatenate([p[k] for p in parts]), order, starts) for k in (1, 2)]
    where = np.split(spots(order, starts), np.cumsum([p.shape[1] for p in parts])[:-1])
    rest = np.zeros(len(parts) - 1, np.int64)
    made = [pa.array([packed(sums[0][w], sums[1][w]) for w in where], pa.binary())]
    made += [pa.array(np.concatenate([[np.int64(n)], rest])) for n in (len(keys), sums[0].sum(), sums[1].sum())]
    return pa.table([table.column("range"), table.column("kind"), table.column("chunk"), *made], ["range", "kind", "chunk", "sums", "n_distinct", "target", "every"])


def losses(joint: np.ndarray, led: np.ndarray, single: np.ndarray, total: float, n_words: int) -> np.ndarray:
    """Loss of each pair's second word, from the counts of the pair, of the first word and of the second."""
    alone = (single + ADDED) / (total + ADDED * n_words)
    weight = np.where(led > 0, PAIR_WEIGHT, 0.0)
    return -np.log(weight * joint / np.maximum(led, 1e-9) + (1 - weight) * alone)


def _score(n_words: int, target: int, every: int):
    total = float(target or every)
    scales = (1.0, target / every) if target else (1.0, 1.0)

    def run(chunk: pa.Table, sums: pa.Table) -> pa.Table:
        ids = chunk.column("ids").combine_chunks()[0].values
        words, before, pairs, first = tokens(_texts(len(ids), chunk.column("texts")[0].as_py()))
        found = {_WORDS: [], _PAIRS: []}
        for place in np.lexsort([sums.column("range").to_numpy()]):
            found[sums.column("kind")[place].as_py()].append(unpacked(sums.column("sums")[int(place)].as_py(), 2))
        counts = [np.concatenate(found[kind], axis=1).astype(float) if found[kind] else np.zeros((2, 0)) for kind in (_WORDS, _PAIRS)]
        of_word, of_pair = (spots(*distinct(h)[1:]) for h in (words, pairs))
        led_by = np.zeros_like(of_word)
        led_by[1:] = of_word[:-1]
        opens = before == 0
        out = np.zeros((2, len(words) + 1))
        for k in (0, 1):
            # Without a target both models are the background's.
            single, joint = (c[k if target else 1] * scales[k] for c in counts)
            np.cumsum(losses(joint[of_pair], np.where(opens, 0.0, single[led_by]), single[of_word], total, n_words), out=out[k, 1:])
        n = np.diff(first)
        mean = (out[:, first[1:]] - out[:, first[:-1]]) / np.maximum(n, 1)
        return pa.table([ids, pa.array(n), pa.array(mean[0]), pa.array(mean[1]), pa.array(mean[0] - mean[1])], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return run


def entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Losses and score for every row of ``docs(doc_id, text)``; ``target(doc_id)`` names the good ones."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    good = target.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chunks = materialized(docs.mapInArrow(_pack, _CHUNKS), "chunks")
    n_tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = max(RANGES, 1 << (n_tokens // RANGE_TOKENS).bit_length())
    # Labels grow with the corpus: they are merged and never broadcast, at any size.
    places = chunks.select("chunk", F.posexplode("ids").alias("place", "doc_id"))
    marked = places.join(good.hint("merge"), "doc_id").groupBy("chunk").agg(F.collect_list("place").alias("good"))
    whole = chunks.select("chunk", F.size("ids").alias("rows"), "texts").join(marked.hint("merge"), "chunk", "left")
    sent = whole.mapInArrow(_send(ranges), _SENT)
    sums = materialized(sent.groupBy("range", "kind").applyInArrow(_add, _SUMS), "sums")
    sizes = sums.filter(F.col("kind") == _WORDS).agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_distinct", "target", "every"))).first()
    each = chunks.select("chunk", "ids", "texts").groupBy("chunk").cogroup(sums.select("chunk", "range", "kind", "sums").groupBy("chunk"))
    return each.applyInArrow(_score(*sizes), _RESULT)
