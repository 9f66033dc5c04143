"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard similarity.

A document's set holds its distinct n-word shingles. Two fixed permutations make all
signature coordinates: the first puts the shingles in random places of a ring, the second,
shifted by k along the ring, gives coordinate k as the least value met. Bands of coordinates
bring candidates together, and every link is confirmed on the full sets.

Copies with equal sets are one node. In a band's bucket, members first meet the one with the
lowest id alone. That settles most buckets: their members end in one component. The buckets
that hold several are put together where they share members, and in such a group every
document outside its largest component meets all others of the group, in cells of bounded
size that give back only the links which join two components. So a group of thousands of
near copies needs a few links a document and never all its pairs, and yet no link between
different components goes unseen.

Defined results: empty or NULL text has an empty set, links with nothing and is kept. Rows
with one id are one document. A row without an id has no component and is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.operators.skew import unnest
from deskmill.session import materialized

#: 52 bands of 7 coordinates: a pair of similarity 0.8 has no band in common 5 times in a million.
BANDS, ROWS = 52, 7
#: Bytes of text on either side of a cell, about.
CELL_BYTES = 4 << 20
#: Standard deviations below the wanted similarity at which signatures rule a pair out.
SLACK = 6.0

_SIGNED = "doc_id long, n_shingles long, set_id string, signature binary"


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; fewer words than that make one shingle."""
    data, offsets = arrays.utf8(texts)
    data = arrays.LOWER[data]
    starts, stops, first = arrays.spans(data, offsets, arrays.BLANK)
    hashes = arrays.span_hashes(data, starts, stops)
    grams = arrays.gram_hashes(hashes, words)
    sets = []
    for low, high in zip(first[:-1], first[1:], strict=True):
        if high - low >= words:
            sets.append(np.unique(grams[low : high - words + 1]))
        else:
            sets.append(arrays.gram_hashes(hashes[low:high], high - low) if high > low else hashes[:0])
    return sets


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """Circulant MinHash, one row of ``k`` coordinates for every set; none may be empty."""
    # Places on a ring of 2**32: the first permutation. The hashes are random already.
    places = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    begins = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), k), np.uint32)
    value, part = np.empty_like(places), np.empty_like(places)
    for shift in range(k):
        # The second permutation of the ring, after a step of ``shift`` along it.
        np.add(places, np.uint32(shift), out=value)
        for right, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            np.right_shift(value, np.uint32(right), out=part)
            np.bitwise_xor(value, part, out=value)
            np.multiply(value, np.uint32(factor), out=value)
        np.right_shift(value, np.uint32(16), out=part)
        np.bitwise_xor(value, part, out=value)
        out[:, shift] = np.minimum.reduceat(value, begins)
    return out


def ruled_out_below(k: int, percent: int) -> float:
    """Equal coordinates, of ``k`` cut to a byte, that a pair similar enough falls short of once in 10**9."""
    share = percent / 100
    return k * share - SLACK * np.sqrt(k * share * (1 - share))


def _sign(words: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.slices(batches, "text", 1 << 19):
            sets = shingle_sets(batch.column("text"), words)
            filled = [i for i, s in enumerate(sets) if len(s)]
            cut: list[bytes | None] = [None] * len(sets)
            if filled:
                # A byte of each coordinate is enough: others meet by chance once in 256 times.
                made = signatures([sets[i] for i in filled], k).astype(np.uint8)
                for i, row in zip(filled, made, strict=True):
                    cut[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], pa.string()),
                    pa.array(cut, pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_id", "signature"],
            )

    return run


def _alike(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("sig_a", "sig_b"))
            if batch.num_rows:
                equal = (one == other).reshape(batch.num_rows, -1).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(equal >= least))

    return run


def _confirm(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(arrays.slices([whole], "text_a"), "text_b"):
                both = zip(shingle_sets(batch.column("text_a"), words), shingle_sets(batch.column("text_b"), words), strict=True)
                linked = []
                for one, other in both:
                    shared = np.intersect1d(one, other, assume_unique=True).size
                    linked.append(100 * shared >= percent * (one.size + other.size - shared) and shared > 0)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _meet(words: int, percent: int, least: float):
    def similar(one: np.ndarray, other: np.ndarray) -> bool:
        shared = np.intersect1d(one, other, assume_unique=True).size
        return 100 * shared >= percent * (one.size + other.size - shared)

    def run(cell: pa.Table) -> pa.Table:
        """Links that join components: each row of side 0 meets each of side 1, the most alike first."""
        nodes = cell.column("node").to_numpy()
        labels = cell.column("component").to_numpy()
        size = cell.column("n_shingles").to_numpy()
        text = cell.column("text").combine_chunks()
        signs = np.frombuffer(b"".join(cell.column("signature").to_pylist()), np.uint8).reshape(len(nodes), -1)
        side = cell.column("side").to_numpy()
        ours, others = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        sets: dict[int, np.ndarray] = {}

        def shingles(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_sets(text.slice(i, 1), words)[0]
            return sets[i]

        labels = labels.copy()
        links = []
        for i in ours:
            fit = (labels[others] != labels[i]) & (100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i]))
            near = others[fit]
            equal = (signs[near] == signs[i]).sum(axis=1)
            near = near[equal >= least][np.argsort(-equal[equal >= least], kind="stable")]
            for j in near:
                if labels[i] != labels[j] and similar(shingles(i), shingles(j)):
                    links.append((int(nodes[i]), int(nodes[j])))
                    labels[labels == labels[j]] = labels[i]
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def components(links: DataFrame) -> DataFrame:
    """Every node of ``links(a, b)`` with the lowest node that it can reach, as ``node, component``.

    Alternates two steps on the edges, each of which hangs neighbours below the lowest among
    them, until nothing changes. Every round is written to the shared folder.
    """
    edges = materialized(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = materialized(small.filter("u <> v").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Documents whose sets have a similarity of ``percent`` or more are linked; a component
    holds all that links reach, is named by its lowest id, and keeps that document alone.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialized(docs.mapInArrow(_sign(words, bands * rows), _SIGNED), "signed")
    nodes = materialized(
        signed.filter("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("node")), "nodes"
    )  # one row for each distinct set
    one_each = signed.join(nodes, "set_id").filter("doc_id = node")
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * rows + 1, F.lit(rows))))
    in_bands = unnest(one_each, "node", "n_shingles", array=keys, value="bucket")
    shared = in_bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("leader")).filter("n > 1")
    meeting = materialized(in_bands.join(shared, "bucket").select("bucket", "node", "n_shingles", "leader").distinct(), "buckets")
    # Texts of documents that share a bucket with another: all that later rounds read.
    texts = materialized(
        docs.join(meeting.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts"
    )

    signs = one_each.select("node", "signature")

    def confirmed(pairs: DataFrame) -> DataFrame:
        one, other = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
        sig_a, sig_b = (signs.select(F.col("node").alias(x), F.col("signature").alias(f"sig_{x}")) for x in "ab")
        pairs = pairs.join(sig_a, "a").join(sig_b, "b").select("a", "b", "sig_a", "sig_b")
        pairs = materialized(pairs.mapInArrow(_alike(ruled_out_below(bands * rows, percent)), "a long, b long"), "pairs")
        found = pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
        return materialized(found.mapInArrow(_confirm(words, percent), "a long, b long"), "confirmed")

    def likely(pairs: DataFrame) -> DataFrame:
        """Sets that differ too much in size cannot be similar enough."""
        return pairs.filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("a", "b").distinct()

    sizes = one_each.select(F.col("node").alias("leader"), F.col("n_shingles").alias("n_b"))
    first = meeting.filter("node <> leader").select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), "leader").distinct()
    links = confirmed(likely(first.join(sizes, "leader").withColumnRenamed("leader", "b")))
    found = components(links)
    # The leaders have met everyone in their buckets.
    labelled = meeting.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    unsettled = materialized(labelled.join(mixed, "bucket").select("node", "leader", "n_shingles", "component").distinct(), "unsettled")
    if not unsettled.isEmpty():
        groups = components(unsettled.select(F.col("node").alias("a"), F.col("leader").alias("b")))
        groups = groups.select("node", F.col("component").alias("group"))
        groups = groups.unionAll(groups.select(F.col("group").alias("node"), "group")).distinct()
        members = unsettled.select("node", "n_shingles", "component").distinct().join(groups, "node")
        members = members.join(signs, "node").join(texts.withColumnRenamed("doc_id", "node"), "node")
        members = materialized(members, "members")
        cells = members.groupBy("group", "component").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
        cells = cells.groupBy("group").agg(
            F.max_by("component", F.struct("n", "component")).alias("largest"),
            F.ceil(F.sum("bytes") / cell_bytes).cast("int").alias("n_others"),
            F.ceil((F.sum("bytes") - F.max_by("bytes", F.struct("n", "component"))) / cell_bytes).cast("int").alias("n_ours"),
        )
        placed = members.join(cells, "group")
        own = placed.filter("component <> largest").select(
            "*", F.lit(0).alias("side"), F.pmod(F.xxhash64("node"), "n_ours").alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_others") - 1)).alias("j")
        )
        other = placed.select(
            "*", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("n_ours") - 1)).alias("i"), F.pmod(F.xxhash64("node"), "n_others").alias("j")
        )
        rows_of = ["group", "i", "j", "side", "node", "component", "n_shingles", "signature", "text"]
        both = own.select(*rows_of).unionByName(other.select(*rows_of))
        meet = _meet(words, percent, ruled_out_below(bands * rows, percent))
        # By a hash of its own, else all cells of a group would stay where the group was joined.
        both = both.withColumn("cell", F.xxhash64("group", "i", "j"))
        joined = materialized(both.groupBy("cell").applyInArrow(meet, "a long, b long"), "joined")
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(joined))

    named = nodes.join(found, "node", "left").select("set_id", F.coalesce("component", "node").alias("component"))
    whole = signed.join(named, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return whole.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def distinct_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component.

    Rows without an id stay; of several rows with one id, one stays.
    """
    found = near_duplicates(docs, words, percent)
    name = "dropped"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    dropped = materialized(found.filter("NOT kept").select(F.col("doc_id").alias(name)).distinct(), "dropped")
    known = docs.filter(F.col("doc_id").isNotNull()).join(dropped, F.col("doc_id").cast("long") == F.col(name), "left_anti")
    return known.dropDuplicates(["doc_id"]).unionByName(docs.filter(F.col("doc_id").isNull()))
