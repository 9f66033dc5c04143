"""Secrets in texts, told from examples by how widely each value is owned.

Spans of fixed forms (an assignment to a password-like name, an access key, a long
hexadecimal run) always stay. Beside them, any long token of mixed signs and high entropy is a
candidate. The hash of each candidate's value, the fixed forms' included, is counted over the
whole corpus by distinct repositories and owners. A value that many owners hold, or that lies in
many repositories for each of its owners, is an example that was copied around; any other
belongs to its owners, and such a token looks live and adds a span.

Counting goes by (value, repository, owner), then by value, each combined before it is
shuffled, so a value copied into a third of all documents costs its tasks one row each.

Defined results: NULL and empty text have no spans; repeated rows are one repository, and
each keeps its own spans; a NULL repository or owner counts as one of its own.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.session import materialized

#: Kinds in the order in which spans of one start are listed, and their forms.
KINDS = ["assign", "access", "hex", "live"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
NAMES = [b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"]

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")
#: A candidate token has this many characters, letters and digits, and bits per character.
TOKEN_LEAST, TOKEN_DIGITS, TOKEN_BITS = 20, 3, 3.2
#: A value that so many owners hold is an example.
EXAMPLE_OWNERS = 4
#: So is one in so many repositories for each of its owners.
EXAMPLE_REPOS = 10
#: Verdicts on a candidate.
COPIED, OWNED = "copied", "owned"

_HEX_BYTES = arrays.byte_table("0123456789abcdef")
_TOKEN_BYTES = arrays.byte_table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")

Span = tuple[str, int, int]

_FOUND = (
    "row long, doc_id long, repo string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "base array<struct<kind: int, start: long, end: long>>, candidates array<struct<value: long, kind: int, start: long, end: long>>"
)


def base_spans(text: str) -> list[tuple[Span, str]]:
    """Spans of the fixed forms and the value of each, by start, then kind as listed."""
    found = [(("assign", *m.span()), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        found += [((kind, *m.span()), m[0]) for m in pattern.finditer(text) if len(m[0]) >= LEAST[kind]]
    return sorted(found, key=lambda f: (f[0][1], KINDS.index(f[0][0])))


def entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def token_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[Span, str]]:
    """Tokens that could be keys and do not overlap the spans that are taken already."""
    found = []
    for m in TOKEN.finditer(text):
        token = m[0]
        digits = sum(c.isdigit() for c in token)
        if len(token) < TOKEN_LEAST or digits < TOKEN_DIGITS or digits + sum(c in "+/_=-" for c in token) == len(token):
            continue
        if entropy(token) >= TOKEN_BITS and not any(a < m.end() and m.start() < b for a, b in taken):
            found.append((("live", *m.span()), token))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    for batch in arrays.slices(batches, "text"):
        data, offsets = arrays.utf8(batch.column("text"))
        named = arrays.rows_with(arrays.LOWER[data], offsets, *NAMES)
        access = arrays.rows_with(data, offsets, b"AKIA")
        runs = arrays.rows_with_run(data, offsets, _HEX_BYTES, LEAST["hex"]) | arrays.rows_with_run(data, offsets, _TOKEN_BYTES, TOKEN_LEAST)
        look = named | access | runs
        out: list[list] = [[] for _ in range(7)]
        for i in range(batch.num_rows):
            base, more = [], []
            if look[i]:
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                base = base_spans(text)
                more = token_spans(text, [s[1:] for s, _ in base]) if runs[i] else []
            spans = [s for s, _ in base]
            kinds = Counter(s[0] for s in spans)
            for column, value in zip(
                out,
                [
                    row,
                    *(kinds[k] for k in KINDS[:3]),
                    hashlib.sha256(joined(spans).encode()).hexdigest(),
                    [_parts(s) for s in spans],
                    [_parts(s) | {"value": _value(v)} for s, v in base + more],
                ],
                strict=True,
            ):
                column.append(value)
            row += 1
        numbers, spans = pa.int64(), [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
        kinds = [numbers] * 4 + [pa.string(), pa.list_(pa.struct(spans)), pa.list_(pa.struct([("value", numbers), *spans]))]
        made = [pa.array(values, kind) for values, kind in zip(out, kinds, strict=True)]
        known = [batch.column(c) for c in ("doc_id", "repo", "owner")]
        names = ["row", "doc_id", "repo", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "base", "candidates"]
        yield pa.RecordBatch.from_arrays([made[0], *known, *made[1:]], names)


def _parts(span: Span) -> dict:
    return {"kind": KINDS.index(span[0]), "start": span[1], "end": span[2]}


def _value(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def secrets(docs: DataFrame, repo: str = "doc_id", owner: str = "source", example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """Spans of every row of ``docs(doc_id, text, ...)``; ``repo`` and ``owner`` name its columns.

    ``spans`` holds the fixed forms and the live-looking tokens as ``kind:start:end``;
    ``n_live`` counts the latter and ``n_examples`` the copied values. ``candidates`` lists every
    candidate as ``kind:start:end:verdict:n_repos:n_owners``; there ``live`` is any token beside
    the fixed forms, whatever its verdict.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(repo).cast("string").alias("repo"),
        F.col(owner).cast("string").alias("owner"),
    )
    found = materialized(docs.mapInArrow(_find, _FOUND), "candidates")
    each = found.select("row", "repo", "owner", F.explode("candidates").alias("c")).select("row", "repo", "owner", "c.*")
    held = each.groupBy("value", "repo", "owner").agg(F.lit(1).alias("one"))
    by_owner = held.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    known = by_owner.groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))
    example = (F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos * F.col("n_owners"))
    judged = each.join(known, "value").withColumn("example", example)
    live = KINDS.index("live")
    per_row = judged.groupBy("row").agg(
        F.sum(F.col("example").cast("long")).alias("n_examples"),
        F.collect_list(F.when((F.col("kind") == live) & ~F.col("example"), F.struct("kind", "start", "end"))).alias("added"),
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "example", "n_repos", "n_owners"))).alias("judged"),
    )
    whole = found.join(per_row, "row", "left")
    empty = F.array().cast("array<struct<kind: int, start: bigint, end: bigint>>")
    every = F.sort_array(
        F.transform(
            F.concat("base", F.coalesce("added", empty)),
            lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
    )
    names = F.array(*map(F.lit, KINDS))
    written = F.transform(every, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"]))
    verdict = lambda s: F.when(s["example"], COPIED).otherwise(OWNED)
    told = F.transform("judged", lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"], verdict(s), s["n_repos"], s["n_owners"]))
    return whole.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(written, ",").alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
        F.coalesce(F.array_join(told, ","), F.lit("")).alias("candidates"),
    )
