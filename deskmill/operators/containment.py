"""Which documents hold a passage, word for word."""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from deskmill.functions.text import let
from deskmill.operators.skew import unnest
from deskmill.session import materialized

WORDS = 5
#: Letters of a passage that the automaton holds, and bytes of passages looked for in one reading.
START = 32
PART_BYTES = 1 << 20


def _grams(parts: Column, n: int, glue: str) -> Column:
    """Hashes of all runs of ``n`` parts."""

    def hashes(parts: Column) -> Column:
        last = F.size(parts) - n + 1
        starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: _hash(F.slice(parts, at, n), glue))

    return let(parts, hashes)


def _hash(parts: Column, glue: str) -> Column:
    return F.xxhash64(F.array_join(parts, glue))


def _words(text: Column) -> Column:
    return F.split(text, r"\s+")


def _parts(passages: DataFrame) -> Iterator[list[str]]:
    """The passages in parts of about ``PART_BYTES``, by a hash of each."""
    total = passages.agg(F.coalesce(F.sum(F.octet_length("passage")), F.lit(0))).first()[0]
    n = math.ceil(total / PART_BYTES)
    for i in range(n):
        some = passages.filter(F.pmod(F.xxhash64("passage"), F.lit(n)) == i)
        held = sorted(r["passage"] for r in some.select("passage").collect())  # of bounded size
        if held:
            yield held


def _read_for(documents: DataFrame, held: list[str]) -> DataFrame:
    """``(passage, doc_id)`` by an Aho-Corasick automaton over the beginnings of the passages.

    Each text is read once, however many passages there are; a longer passage whose beginning
    was met is then looked for as a whole. Rows stay where they were read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(held)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_start: dict[str, list[str]] = {}
        for passage in shared.value:
            by_start.setdefault(passage[:START], []).append(passage)
        machine = ahocorasick.Automaton()
        for start in by_start:
            machine.add_word(start, start)
        machine.make_automaton()
        for batch in batches:
            row, found = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for start in {start for _, start in machine.iter(text)} if text else ():
                    for passage in by_start[start]:
                        if len(passage) <= START or passage in text:
                            row.append(i)
                            found.append(passage)
            ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), ids], ["passage", "doc_id"])

    schema = StructType([StructField("passage", StringType()), documents.schema["doc_id"]])
    return documents.select("doc_id", "text").mapInArrow(find, schema)


def passages_in_documents(passages: DataFrame, documents: DataFrame) -> DataFrame:
    """``(passage, doc_id)`` for every document whose text contains the passage.

    ``passages(passage)``, ``documents(doc_id, text)``. No passage is compared with every
    document. The words inside a passage, all but its first and last, are whole words of
    any document that contains it; so the first ``WORDS`` of them must be a run of words
    there, and the two meet by the hash of that run. Candidates are then checked by
    ``contains``. Passages of too few words, or of a script without spaces, are looked for in
    the texts themselves, all of a part of ``PART_BYTES`` in one reading. The empty passage
    is in every document that has a text.
    """
    every = passages.filter("passage IS NOT NULL").select("passage").distinct()
    known = every.filter("passage <> ''")
    words = _words(F.col("passage"))
    long = F.size(words) >= WORDS + 2
    docs = documents.select("doc_id", "text")

    anchors = known.filter(long).select("passage", _hash(F.slice(words, 2, WORDS), " ").alias("gram"))
    runs = unnest(docs, "doc_id", array=F.array_distinct(_grams(_words(F.col("text")), WORDS, " ")), value="gram")
    candidates = runs.join(anchors, "gram").select("passage", "doc_id")

    # Few documents are candidates; with their number known their texts need no shuffle.
    checked = materialized(candidates.distinct(), "candidates")
    found = (
        checked.join(documents.select("doc_id", "text"), "doc_id")
        .filter(F.col("text").contains(F.col("passage")))
        .select("passage", "doc_id")
    )
    for held in _parts(known.filter(~long)):
        found = found.unionByName(_read_for(docs, held))
    if every.filter("passage = ''").isEmpty():
        return found
    # The empty passage is in every text.
    return found.unionByName(docs.filter("text IS NOT NULL").select(F.lit("").alias("passage"), "doc_id"))


def groundedness(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Per item ``(item_id, text)``: how many documents contain its text."""
    held = passages_in_documents(items.select(F.col("text").alias("passage")), documents)
    counts = held.groupBy("passage").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return items.join(counts, items["text"] == counts["passage"], "left").select(
        "item_id", n.alias("n_documents"), (n > 0).alias("grounded")
    )
