"""Merkle manifest of a dataset, with nodes labelled by the leaf ranks that they cover.

The leaves of a tree are numbered along its order; a node of level *l* covers the ranks from
``lo`` up to ``hi``, at most ``16 ** l`` of them. So the parent of a node is found by an equality
join on the bucket ``lo div 16 ** (l + 1)`` with a test that its interval contains the node's, and
the siblings are what the parent's interval holds before ``lo`` and from ``hi`` on. Each node
meets one parent and each parent at most 16 children, so no join has a hot key, however large
one source is. What lies above a node (its path to the root) is handed down level by level.
"""

from __future__ import annotations

import dataclasses
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.llm.ordering import running
from deskmill.session import materialized

#: Nodes that become one node of the next level.
FANOUT = 16
#: Powers of the fan-out that a rank can reach.
_LEVELS = 15

_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(nodes: Column) -> Column:
    """The digests of an array of nodes as one hex text."""
    return F.array_join(F.transform(nodes, lambda c: _hex(c["digest"])), "")


def leaf_digest(**changed: Column) -> Column:
    """SHA-256 of a row's fields, each ``-`` if NULL, else ``<UTF-8 bytes>:<value>``."""
    parts = []
    for name in _FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


@dataclasses.dataclass
class Forest:
    """Nodes by level: ``tree, n, lo, hi, digest`` and, above the leaves, ``children``."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """``tree, top`` of every tree: the node that remains, a lone leaf itself."""
        found = None
        for level, nodes in enumerate(self.levels):
            here = nodes.filter(_height() == level).select("tree", F.col("digest").alias("top"))
            found = here if found is None else found.unionByName(here)
        return found

    def paths(self, above: DataFrame) -> DataFrame:
        """The leaves with ``path`` (nearest run first) and the other columns of ``above``.

        ``above`` has one row a tree, with ``tree``, the ``path`` above its top and anything else.
        """
        carried = [c for c in above.columns if c not in ("tree", "path")]
        upper = None
        for level in reversed(range(len(self.levels))):
            nodes = self.levels[level]
            at_top = nodes.filter(_height() == level).join(above, "tree")
            if upper is not None:
                at_top = at_top.unionByName(_below(nodes.filter(_height() > level), upper, level, carried))
            upper = at_top
        return upper


def _height() -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return sum(((F.col("n") > FANOUT**i).cast("int") for i in range(1, _LEVELS + 1)), (F.col("n") > 1).cast("int"))


def _bucket(level: int) -> Column:
    return F.expr(f"lo div {FANOUT**level}L")


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of ``level``, made from those one level below."""
    below = nodes.filter(_height() >= level).withColumn("_bucket", _bucket(level))
    runs = below.groupBy("tree", "_bucket").agg(
        F.max("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"),  # at most 16
    )
    return runs.withColumn("digest", F.unhex(F.sha2(_joined(F.col("children")), 256))).drop("_bucket")


def _below(nodes: DataFrame, upper: DataFrame, level: int, carried: list[str]) -> DataFrame:
    """Nodes of ``level`` that have a parent, with the path that begins among their siblings."""
    parents = upper.select(
        F.col("tree").alias("_tree"),
        _bucket(level + 1).alias("_at"),
        F.col("lo").alias("_lo"),
        F.col("hi").alias("_hi"),
        F.col("children").alias("_run"),
        F.col("path").alias("_path"),
        *carried,
    )
    inside = (F.col("lo") >= F.col("_lo")) & (F.col("hi") <= F.col("_hi"))
    met = nodes.withColumn("_bucket", _bucket(level + 1)).join(
        parents, (F.col("tree") == F.col("_tree")) & (F.col("_bucket") == F.col("_at")) & inside
    )
    left = _joined(F.filter("_run", lambda c: c["hi"] <= F.col("lo")))
    right = _joined(F.filter("_run", lambda c: c["lo"] >= F.col("hi")))
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    return met.withColumn("path", F.concat(step, "_path")).drop("_tree", "_at", "_lo", "_hi", "_run", "_path", "_bucket")


def grown(leaves: DataFrame, keys: list[str], order: list[str]) -> Forest:
    """Trees over a stored table with ``tree`` and ``digest``, each in ``order``.

    Every level is stored. Rows that are equal in the order are equal leaves: any order among
    them gives the same tree.
    """
    ranked = running(leaves, keys, order, {"lo": F.lit(1)})
    ranked = ranked.withColumnRenamed("lo_total", "n").withColumn("hi", F.col("lo") + 1)
    levels = [materialized(ranked, "leaves")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while FANOUT ** (len(levels) - 1) < most:
        levels.append(materialized(_parents(levels[-1], len(levels)), "nodes"))
    return Forest(levels)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give, as hex text."""
    return F.aggregate(path, _hex(start), lambda acc, run: F.sha2(F.concat(run["left"], acc, run["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings along a path, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), ""), 256)


def with_proofs(docs: DataFrame, **extra: Column) -> DataFrame:
    """``doc_id, leaf, subroot, root, path`` of every row of ``docs``, and the columns of ``extra``.

    ``docs`` has ``doc_id, source, lang, n_chars, text``; other columns are left out. Sources make
    a tree each, leaves ascending by ``doc_id`` (NULL first, rows of one id by their digest), and
    the tops of these trees, by source (NULL first, then as UTF-8), make the last tree. ``path``
    lists the runs from the leaf to the root, each as the hex digests ``left`` and ``right`` of
    the node; a run of one has neither. A NULL in any column is a field of its own kind; repeated
    rows are leaves of their own; an empty table gives no rows. Digests are binary. Texts are read
    once and only digests are shuffled.
    """
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    made = {"doc_id": F.col("doc_id").cast("long"), "tree": tree, "digest": leaf_digest()} | extra
    stored = materialized(docs.select(*[value.alias(name) for name, value in made.items()]), "digests")
    sources = grown(stored, ["tree"], ["doc_id", "digest"])
    tops = materialized(sources.tops(), "tops")
    all_of = grown(tops.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), F.col("top").alias("digest")), ["tree"], ["source_tree"])
    nothing = F.expr("CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>)")
    root = all_of.tops().select("tree", nothing.alias("path"), F.col("top").alias("root"))
    above = all_of.paths(root).select(F.col("source_tree").alias("tree"), "path", "root", F.col("digest").alias("subroot"))
    found = sources.paths(materialized(above, "above"))
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", *extra)


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """A row for each row of ``docs``: its leaf, subroot, root, the digest of its proof, and a check.

    The check folds the proof from the row as it is, or, where ``tampered`` is true, from the row
    with A-Z of its text lowered (NULL stays NULL), and says whether the root comes out. NULL in
    ``tampered`` counts as false. See :func:`with_proofs` for odd rows.
    """
    altered = F.when(tampered, leaf_digest(text=lowered(F.col("text"))))
    rows = with_proofs(docs, altered=altered)
    rows = rows.withColumns({"root": _hex(F.col("root")), "folded_root": folded(F.coalesce("altered", "leaf"), F.col("path"))})
    return rows.select(
        "doc_id",
        _hex(F.col("leaf")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
