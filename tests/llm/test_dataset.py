"""Divergence of sources, the Merkle manifest and the mixture, against plain versions and on odd rows."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deskmill.llm import divergence, manifest, mixing, ordering
from deskmill.llm.ordering import running
from deskmill.session import materialized

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: The columns of documents, and others named as the operators name theirs.
CLASHES = "tree string, digest string, n int, lo int, term string, rank int, place int, origin string, size int, row int, path string, part int"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES


def plain_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def docs_of(spark, rows):
    """Documents from (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x", "y", 1, 2, "z", 3, 4, "o", 5, 6, "p", 7) for r in rows], SCHEMA)


def odd_rows():
    rng = random.Random(11)
    some = "Alpha beta gamma delta épsilon ZETA Ünï eta theta x1y can't 12 日本 日本語".split()
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \n\t ", "en", ""),
        (4, "12 34 -- 5", "xx", "a"),
        (5, " ".join(rng.choice(some) for _ in range(40_000)), "en", "a"),
        (None, "One two", "de", "b"),
        (None, "One two three", None, "b"),
        (6, "same Id one", "de", "b"),
        (6, "same id two", "de", "b"),
    ]
    rows += [(7, "Repeated Row", "de", "hot")] * 40
    rows += [(100 + i, " ".join(rng.choice(some) for _ in range(rng.randrange(30))), rng.choice(["en", "de"]), rng.choice(["a", "b", "ü", None])) for i in range(120)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, odd_rows()).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


# --- running sums ------------------------------------------------------------------------------


def test_running_sums_cut_a_hot_key_and_a_repeated_row(spark, tmp_path):
    rows = [("hot", 5, 1)] * 6000 + [("hot", i, i) for i in range(2000)] + [("cold", 1, 7), ("cold", None, 2)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "key string, at long, v long").repartition(4).write.parquet(path)
    found = running(spark.read.parquet(path), ["key"], ["at"], {"sum": F.col("v"), "place": F.lit(1)}).collect()
    got = sorted((r["key"], r["place"], r["at"] is not None, r["at"], r["sum"], r["sum_total"]) for r in found if r["key"] == "hot")
    want, total = [], 0
    for i, (_, at, v) in enumerate(sorted(r for r in rows if r[0] == "hot")):
        want.append((i, at))
        total += v
    assert [(r[1], r[3]) for r in got] == want and {r[5] for r in got} == {total}
    by_place = sorted((r["place"], r["v"], r["sum"]) for r in found if r["key"] == "hot")
    assert all(a[2] + a[1] == b[2] for a, b in zip(by_place, by_place[1:]))
    assert sorted((r["place"], r["at"], r["sum"]) for r in found if r["key"] == "cold") == [(0, None, 0), (1, 1, 2)]


def test_running_sums_cut_a_repeated_row(spark, tmp_path, monkeypatch):
    """One row is three quarters of the table; no range holds more than its share."""
    path, parts = str(tmp_path / "rows"), []
    spark.createDataFrame([("hot", 5)] * 6000 + [("hot", i) for i in range(2000)], "key string, at long").repartition(4).write.parquet(path)
    monkeypatch.setattr(ordering, "materialized", lambda df, label: parts.append(materialized(df, label)) or parts[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        running(spark.read.parquet(path), ["key"], ["at"], {"place": F.lit(1)}).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in parts[0].groupBy("_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2 * sum(sizes) / len(sizes)


# --- divergence --------------------------------------------------------------------------------


def plain_divergence(rows, least=3, ranks=200):
    found = collections.defaultdict(collections.Counter)
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang, source in rows:
        words = TERMS.findall(plain_lower(text or ""))
        found[lang or ""].update(set(words))
        counts[lang or "", source or ""].update(words)
    out = set()
    for lang in found:
        terms = [t for t, n in found[lang].items() if n >= least]
        groups = [g for g in counts if g[0] == lang]
        total = {g: sum(counts[g][t] for t in terms) for g in groups}
        in_lang = {t: sum(counts[g][t] for g in groups) for t in terms}

        def chance(n, of):
            return 1 + 10**9 * (n + 1) // (of + len(terms))

        for g in groups:
            ps = [chance(counts[g][t], total[g]) for t in terms]
            pairs = [(-sum((p - q) ** 2 // q for p, q in zip(ps, (chance(counts[h][t], total[h]) for t in terms))), h[1].encode()) for h in groups if h != g]
            out |= {(lang, g[1], "pair", i.decode(), -v, k) for k, (v, i) in enumerate(sorted(pairs), 1)}
            whole = sum(total.values())
            over = [(p, chance(in_lang[t], whole), t) for t, p in zip(terms, ps) if counts[g][t]]
            best = sorted((-((p - q) ** 2 // q), t.encode()) for p, q, t in over if p > q)
            out |= {(lang, g[1], "term", i.decode(), -v, k) for k, (v, i) in enumerate(best[:ranks], 1)}
    return out


@pytest.mark.parametrize("ranks", [200, 3])
def test_divergence_of_odd_rows(spark, odd, ranks):
    got = [tuple(r) for r in divergence.divergence(odd, ranks=ranks).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_divergence(odd_rows(), ranks=ranks)
    assert {r[:2] for r in got} >= {("en", "ü"), ("de", "hot"), ("de", "")}


def test_divergence_with_many_sources_and_ranges(spark, monkeypatch):
    """More sources than a block and more terms than a range."""
    monkeypatch.setattr(divergence, "RANGE", 16)
    monkeypatch.setattr(divergence, "BLOCK", 4)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdé") for _ in range(1 + i % 5)) for i in range(150)]
    rows = [(i, " ".join(rng.choices(words, range(150, 0, -1), k=60)), rng.choice(["en", "fr"]), f"s{rng.randrange(11)}") for i in range(150)]
    assert {tuple(r) for r in divergence.divergence(docs_of(spark, rows), ranks=7).collect()} == plain_divergence(rows, ranks=7)


def test_divergence_of_nothing(nothing):
    got = divergence.divergence(nothing)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and got.collect() == []


def test_divergence_is_exact_beyond_64_bits(spark):
    got = spark.range(1).select(divergence.chance(F.lit(40_000_000_000), F.lit(90_000_000_000), F.lit(7)).alias("p")).first()["p"]
    assert got == 1 + 10**9 * 40_000_000_001 // 90_000_000_007


@pytest.mark.parametrize("k", [1, 4])
def test_skyband_keeps_what_fewer_than_k_dominate(k):
    rng = np.random.default_rng(k)
    rows = [(int(n), int(m), f"{t:04d}é") for n, m, t in zip(rng.integers(1, 12, 3000), rng.integers(1, 40, 3000), rng.permutation(3000))]
    rows.sort(key=lambda r: (-r[0], r[1], r[2].encode()))
    batch = pa.record_batch({"lang": ["en"] * 3000, "source": ["s"] * 3000, "term": [r[2] for r in rows], "n": [r[0] for r in rows], "lang_n": [r[1] for r in rows]})
    got = [t for b in divergence._banded(k)([batch.slice(0, 1000), batch.slice(1000)]) for t in b.column("term").to_pylist()]
    want = [c for a, b, c in rows if sum(x >= a and y <= b and z < c for x, y, z in rows) < k]
    assert got == want and len(got) < 1500


# --- manifest ----------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_path(levels, i):
    out = []
    for level in levels[:-1]:
        begin = i // 16 * 16
        out.append((level[begin:i], level[i + 1 : begin + 16]))
        i //= 16
    return out


def plain_manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars)."""

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row, text):
        return sha("".join(field(v) for v in (row[0], row[3], row[2], row[4], text)))

    sources = collections.defaultdict(list)
    for row in rows:
        sources[row[3]].append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        held = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[name] = held, plain_tree([leaf(r, r[1]) for r in held])
    forest = plain_tree([trees[name][1][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        held, levels = trees[name]
        for i, row in enumerate(held):
            path = plain_path(levels, i) + plain_path(forest, k)
            tampered = row[0] is not None and row[1] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            now = leaf(row, plain_lower(row[1]) if tampered else row[1])
            for left, right in path:
                now = sha("".join(left) + now + "".join(right))
            proof = sha("".join("".join(left) + "".join(right) for left, right in path))
            out.append((row[0], levels[0][i], levels[-1][0], forest[-1][0], proof, now, now == forest[-1][0]))
    return collections.Counter(out)


def every_fifth():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def full(rows):
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def test_manifest_of_odd_rows(odd):
    got = collections.Counter(tuple(r) for r in manifest.manifest(odd, every_fifth()).collect())
    assert got == plain_manifest(full(odd_rows()))
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [1, 1], [16], [17], [257, 1, 16, 15], [1] * 18, [300, 2] + [1] * 20])
def test_manifest_of_trees_of_all_heights(spark, sizes):
    rows = [(1000 * s + i, f"Text {i}", "en", f"s{s:02d}") for s, n in enumerate(sizes) for i in range(n)]
    got = collections.Counter(tuple(r) for r in manifest.manifest(docs_of(spark, rows), every_fifth()).collect())
    assert got == plain_manifest(full(rows))


def test_manifest_of_nothing(nothing):
    assert manifest.manifest(nothing, every_fifth()).collect() == []


def test_a_proof_tells_any_change(spark):
    rows = [(i, f"Text {i}", "en", f"s{i % 3}") for i in range(70)]
    docs = docs_of(spark, rows)
    for changed in ({"lang": F.lit("de")}, {"n_chars": F.lit(None)}, {"source": F.lit("s9")}, {"doc_id": F.col("doc_id") + 1}):
        held = manifest.with_proofs(docs, other=manifest.leaf_digest(**changed))
        root = F.lower(F.hex("root"))
        bad, good = (manifest.folded(F.col(c), F.col("path")) == root for c in ("other", "leaf"))
        assert [tuple(r) for r in held.agg(F.bool_or(bad), F.bool_and(good)).collect()] == [(False, True)]


# --- mixture -----------------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), repeats=3):
    """Targets by reshared excess, as exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = total - sum(full.values())
        free = [n for n in names if n not in full]
        share = {n: Fraction(rest * weight[n], sum(weight[m] for m in free)) for n in free}
        over = [n for n in free if share[n] > repeats * sizes[n]]
        if not over:
            return full | share
        full |= {n: repeats * sizes[n] for n in over}


def plain_mixture(rows):
    sizes, held = collections.Counter(), collections.defaultdict(list)
    for doc_id, text, _, source in rows:
        n = len(WORDS.findall(text or ""))
        sizes[source] += n
        deal = hashlib.md5(b"" if doc_id is None else str(doc_id).encode()).hexdigest()
        held[source].append((deal, doc_id is not None, doc_id or 0, n))
    out = []
    for source, target in plain_targets(sizes).items():
        goal, at = int(target), 0
        for _, known, doc_id, n in sorted(held[source]):
            taken = sum(min(max(goal - k * sizes[source] - at, 0), n) for k in range(3))
            out.append((doc_id if known else None, n, sizes[source], float(target), taken))
            at += n
    return collections.Counter(out)


def test_mixture_of_odd_rows(odd):
    assert collections.Counter(tuple(r) for r in mixing.mixture(odd).collect()) == plain_mixture(odd_rows())


def test_excess_is_shared_out_until_none_is_above(spark):
    rng = random.Random(8)
    rows = [(i, "w " * (s * s * s % 50 + (4000 if s == 4 else 1)), "en", f"s{s}") for i, s in enumerate(rng.randrange(14) for _ in range(90))]
    rows.append((500, "", "en", "s00"))
    got = collections.Counter(tuple(r) for r in mixing.mixture(docs_of(spark, rows)).collect())
    assert got == plain_mixture(rows)
    full = {r[2] for r in got if r[3] == 3 * r[2] > 0}
    assert len(full) >= 3
    assert abs(sum(r[4] * n for r, n in got.items()) - sum(r[1] * n for r, n in got.items())) <= 15
    assert all(r[4] <= 3 * r[1] for r in got)


@pytest.mark.parametrize("text", [None, "", "  "])
def test_mixture_without_words(spark, text):
    got = mixing.mixture(docs_of(spark, [(1, text, "en", "a"), (2, text, "en", None)])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mixture_of_nothing(nothing):
    assert mixing.mixture(nothing).collect() == []


def test_due_inverts_the_integral_of_a_schedule(spark):
    schedules = [*mixing.SCHEDULES, ((0.0, 0.0), (0.25, 4.0), (0.5, 0.0), (1.0, 2.0))]
    parts = spark.range(101).select((F.col("id") / 100).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("turn"))
    for part, turn, at in parts.select("part", "turn", mixing.due(F.col("part"), F.col("turn"), schedules).alias("at")).collect():
        knots = schedules[turn]
        x = np.linspace(0, at, 20_001)
        y = np.interp(x, [k[0] for k in knots], [k[1] for k in knots])
        done = float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum()) / mixing.mean(knots)
        assert 0 <= at <= 1 and abs(done - part) < 1e-6


def test_order_of_training_follows_the_schedules(spark):
    rows = [(i, "w " * 10, "en", f"s{i % 3}") for i in range(1500)]
    placed = mixing.curriculum(mixing.sized(docs_of(spark, rows)))
    pieces = [r.asDict() for r in mixing.training_order(placed).collect()]
    at = [p["position"] for p in pieces]
    assert at == sorted(at) and 0 <= at[0] and at[-1] < 1
    first, last = pieces[: len(pieces) // 4], pieces[-(len(pieces) // 4) :]
    shares = [collections.Counter() for _ in range(2)]
    for some, share in zip((first, last), shares):
        for p in some:
            share[p["origin"]] += p["n_words"]
    assert shares[0]["ss0"] > 1.2 * shares[1]["ss0"] and shares[1]["ss2"] > 1.5 * shares[0]["ss2"]
    once = collections.Counter((p["row"], p["pass"]) for p in pieces)
    assert set(once.values()) == {1}


def test_schedules_need_whole_means(spark):
    docs = docs_of(spark, [(1, "a b", "en", "a")])
    with pytest.raises(ValueError, match="whole number"):
        mixing.mixture(docs, schedules=(((0.0, 1.0), (1.0, 2.0)),))
