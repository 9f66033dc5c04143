import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from check import canonical
from deskmill import plans
from deskmill.functions.embedding import bucket_counts, embed, unit
from deskmill.operators import containment, vectors
from deskmill.operators.skew import number_rows, top_per_key
from deskmill.plans import documents


def frame(spark, vecs, name):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], f"{name} long, vector array<double>")


def brute_force(corpus, queries, k, without_self=False):
    out = []
    for q, query in enumerate(queries):
        scored = []
        for i, held in enumerate(corpus):
            if without_self and i == q:
                continue
            scale = np.linalg.norm(query) * np.linalg.norm(held)
            scored.append((-round(float(query @ held) / scale, 6) if scale else 0.0, i))
        out += [(q, i, -s + 0.0, r + 1) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    corpus = rng.integers(-3, 4, size=(300, 16)).astype(float)
    corpus[100:200] = corpus[7]  # a third of all rows are copies of one vector
    corpus[250] = 0
    return corpus


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0, "block": 37}])
@pytest.mark.parametrize("without_self", [False, True])
def test_search_is_exact_with_copies_ties_and_zeros(spark, data, how, without_self):
    corpus, queries = frame(spark, data, "id").repartition(5), frame(spark, data, "query_id")
    got = vectors.search(corpus, queries, 7, without_self=without_self, **how)
    assert rows(got) == sorted(brute_force(data, data, 7, without_self))


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0, "block": 50}])
def test_vectors_closer_than_single_precision_tells(spark, how):
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    close = base + rng.normal(size=(200, 16)) * np.array([1e-7, 1e-5, 1e-3, 1e-2])[rng.integers(0, 4, 200), None]
    index = frame(spark, close, "id")
    got = vectors.search(index, index.withColumnRenamed("id", "query_id"), 9, **how)  # one table on both sides
    assert rows(got) == sorted(brute_force(close, close, 9))


def test_ranking_does_not_grow_with_queries_times_vectors(monkeypatch):
    rng = np.random.default_rng(11)
    held, asked, k = rng.normal(size=(12_000, 8)), rng.normal(size=(3_000, 8)), 5
    held[5_000:5_400] = held[3]
    asked[7] = held[3]
    ids = rng.permutation(len(held))
    ranked, sizes = vectors._ranked, []

    def counted(table, n):
        sizes.append(table.num_rows)
        return ranked(table, n)

    monkeypatch.setattr(vectors, "CELLS", 60_000)
    monkeypatch.setattr(vectors, "_ranked", counted)
    held_as = pa.array(held.tolist(), pa.list_(pa.float64()))
    batches = pa.table({"id": pa.array(ids), "vector": held_as}).to_batches(max_chunksize=5_000)
    best = vectors._scan(asked, batches, k)
    assert sum(sizes) < 10 * k * len(asked)  # 9 million with one ranking for each CELLS
    got = sorted(zip(*(best[c].to_pylist() for c in ("q", "similarity", "id")), strict=True), key=lambda r: (r[0], -r[1], r[2]))
    cosine = asked @ held.T / np.linalg.norm(asked, axis=1)[:, None] / np.linalg.norm(held, axis=1)
    for q in [7, *range(0, 3_000, 250)]:
        wanted = sorted(zip(-np.round(cosine[q], 6), ids, strict=True))[:k]
        assert [(i, s) for _, s, i in got[q * k : q * k + k]] == [(i, -s) for s, i in wanted]


def test_fewer_vectors_than_wanted(spark, data):
    got = vectors.search(frame(spark, data[:3], "id"), frame(spark, data[:2], "query_id"), 10)
    assert rows(got) == sorted(brute_force(data[:3], data[:2], 10))


def test_no_queries_and_no_vectors(spark, data):
    some = frame(spark, data[:3], "id")
    assert vectors.search(some, frame(spark, data[:2], "query_id").limit(0), 3).count() == 0
    assert vectors.search(some.limit(0), frame(spark, data[:2], "query_id"), 3).count() == 0


def test_approximate_search_in_blocks_and_recall(spark, data):
    corpus, queries = frame(spark, data, "id"), frame(spark, data, "query_id")
    whole = vectors.search_approximately(corpus, queries, 5)
    cut = vectors.search_approximately(corpus, queries, 5, block=9)
    assert rows(whole) == rows(cut)
    exact = vectors.search(corpus, queries, 5)
    assert vectors.recall(exact, exact).first().recall == 1.0
    wide = vectors.search_approximately(corpus, queries, 5, bucket_length=1.0, width=1)
    assert vectors.recall(wide, exact).first().recall > 0.9


def test_recall_floor_on_the_fixture(spark):
    index = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").withColumnRenamed("embedding", "vector")
    near = vectors.search_approximately(
        index.select(F.col("vec_id").alias("id"), "vector"),
        index.select(F.col("vec_id").alias("query_id"), "vector"),
        10,
        without_self=True,
    )
    assert vectors.recall(near, vectors.search_self(index, "vec_id", 10)).first().recall > 0.85


def test_embedding(spark):
    df = spark.createDataFrame([("a b a", 1), ("", 2), (None, 3), ("!?", 4)], "text string, id int").repartition(1)
    got = {r.id: r.v for r in df.select("id", embed(F.col("text")).alias("v")).collect()}
    assert sum(got[1]) == 3 and max(got[1]) == 2 and len(got[1]) == 64
    assert got[2] == got[3] == got[4] == [0] * 64
    units = df.select("id", embed(F.col("text")).alias("e")).select("id", unit(F.col("e")).alias("v")).collect()
    assert abs(sum(x * x for x in units[0].v) - 1) < 1e-12
    assert units[1].v == [0.0] * 64


@pytest.mark.parametrize("at_once", [1, 3, 7, 1000])
def test_bucket_counts_in_parts(at_once):
    rng = np.random.default_rng(1)
    lengths = np.array([0, 5, 0, 0, 9, 1, 0])
    buckets = rng.integers(0, 64, lengths.sum()).astype(np.int8)
    want = [np.bincount(part, minlength=64) for part in np.split(buckets, np.cumsum(lengths)[:-1])]
    assert (bucket_counts(lengths, buckets, at_once) == want).all()
    assert bucket_counts(lengths[:0], buckets[:0]).shape == (0, 64)


def test_sync_equals_rebuild(spark):
    before = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None), (4, "d")], "id long, text string")
    after = spark.createDataFrame([(1, "a b"), (2, "c c"), (3, "x"), (5, "e")], "id long, text string")
    index = vectors.build_index(before, ["id"], "text")
    synced = vectors.sync_index(index, after, "id", "text")
    assert rows(synced.select("id", "content_hash")) == rows(vectors.build_index(after, ["id"], "text").select("id", "content_hash"))
    assert rows(vectors.long_form(synced, ["id"])) == rows(vectors.long_form(vectors.build_index(after, ["id"], "text"), ["id"]))


def test_retrieve_cites_every_source(spark):
    one = vectors.build_index(spark.createDataFrame([("kb://1", "red fox")], "uri string, text string"), ["uri"], "text")
    two = vectors.build_index(spark.createDataFrame([("tickets://1/0", "blue fox")], "uri string, text string"), ["uri"], "text")
    asked = spark.createDataFrame([(9, "red fox")], "query_id int, text string").select("query_id", embed(F.col("text")).alias("vector"))
    hits = vectors.retrieve({"kb": one, "tickets": two}, asked, 5).orderBy("rank").collect()
    assert [(h.source, h.uri, h.rank) for h in hits] == [("kb", "kb://1", 1), ("tickets", "tickets://1/0", 2)]
    assert hits[0].similarity == 1.0


def test_numbering_in_small_blocks(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS pos", "id % 2 AS part").unionByName(
        spark.range(500).selectExpr("0 AS k", "id AS pos", "9 AS part")
    )
    got = number_rows(df, ["k"], "pos", ["part"], "n", block=16).collect()
    for key in range(3):
        mine = sorted((r.pos, r.part, r.n) for r in got if r.k == key)
        assert [n for _, _, n in mine] == list(range(len(mine)))


def test_top_per_key_with_salts(spark):
    df = spark.range(2000).selectExpr("id % 2 AS k", "id")
    got = top_per_key(df, ["k"], [F.desc("id")], 3, salts=5, salt_on=("id",))
    assert rows(got) == [(0, 1994, 3), (0, 1996, 2), (0, 1998, 1), (1, 1995, 3), (1, 1997, 2), (1, 1999, 1)]


def test_containment_against_brute_force(spark):
    documents = {
        1: "say one two three four five six seven eight again",
        2: "stone two three four five six seven eighth",
        3: "one  two three four five six seven eight",  # two spaces: words match, text does not
        4: "short no match",
        5: "xshort",
        6: "",
        7: "日本語の文章です",
    }
    passages = ["one two three four five six seven eight", "short", "two three four", "sh", "本語", "absent words", "short no match", "é"]
    documents[8] = documents[1]
    docs = spark.createDataFrame(list(documents.items()), "doc_id int, text string")
    asked = spark.createDataFrame([(p,) for p in passages * 2], "passage string")
    want = sorted((p, d) for p in passages for d, t in documents.items() if p in t)
    assert rows(containment.passages_in_documents(asked, docs)) == want
    items = spark.createDataFrame([(1, "short"), (2, "absent words"), (3, "short")], "item_id int, text string")
    assert rows(containment.groundedness(items, docs)) == [(1, 2, True), (2, 0, False), (3, 2, True)]


@pytest.mark.parametrize("part_bytes", [1 << 20, 200])
def test_short_passages_and_scripts_without_spaces(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(containment, "PART_BYTES", part_bytes)
    rng = np.random.default_rng(6)
    letters = list("ab c日本語ไทย\n😀")
    texts = ["".join(rng.choice(letters, size=n)) for n in rng.integers(0, 300, 60)] + ["", "日" * 90 + "本", "日" * 40]
    passages = ["a", "ab", "日本", "😀", "ไท ย", "\n", " ", "zz", "日" * 33, "日" * 80 + "本", "日" * 95, "a😀"] + [t[5:50] for t in texts[:20] if len(t) > 50]
    docs = spark.createDataFrame([*enumerate(texts), (900, None)], "doc_id int, text string").repartition(3)
    asked = spark.createDataFrame([(p,) for p in passages] + [(None,)], "passage string")
    want = sorted((p, d) for p in set(passages) for d, t in enumerate(texts) if p in t)
    got = containment.passages_in_documents(asked, docs)
    if part_bytes > 200:  # one reading of the texts for short passages, without a row for each letter
        assert plan(got).count("MapInArrow (") == plan(containment._read_for(docs, ["a"])).count("MapInArrow (")
    assert sorted(map(tuple, got.collect())) == want


def test_rows_without_a_vector_are_left_out(spark):
    data = [(1, [1.0, 0.0]), (2, None), (3, [0.9, 0.1]), (4, [0.0, 1.0])]
    df = spark.createDataFrame(data, "id long, vector array<double>")
    got = vectors.search_self(df, "id", 1).select("query_id", "id")
    assert sorted(map(tuple, got.collect())) == [(1, 3), (3, 1), (4, 3)]


def test_a_vector_of_another_length_has_no_hit(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, [1.0, 0.0])], "id long, vector array<double>").coalesce(1)
    assert rows(vectors.search(df, df.withColumnRenamed("id", "query_id"), 5)) == [(1, 1, 1.0, 1), (1, 3, 1.0, 2), (3, 1, 1.0, 1), (3, 3, 1.0, 2)]



def test_sync_reads_no_old_text(spark, folder):
    old = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "d")], "id long, text string")
    new = spark.createDataFrame([(1, "a b"), (2, "c changed"), (4, "e")], "id long, text string")
    vectors.build_index(old, ["id"], "text").write.parquet(f"{folder}/index")
    synced = vectors.sync_index(spark.read.parquet(f"{folder}/index"), new, "id", "text")
    want = vectors.build_index(new, ["id"], "text")
    assert sorted(map(str, synced.collect())) == sorted(map(str, want.collect()))


def test_a_stored_index_follows_its_table(spark, folder):
    path = f"{folder}/documents.parquet"
    for texts in ([(1, "a b")], [(1, "a b"), (2, "c")]):
        spark.createDataFrame(texts, "doc_id long, text string").write.mode("overwrite").parquet(path)
        assert documents.stored_index(spark, folder).count() == len(texts)


def test_the_search_function_embeds_its_term_once(spark):
    text = plan(documents.search_docs_function(spark, "/root/testdata/sf0.001"))
    main = text[: text.index("===== Subqueries =====")]
    assert "md5" not in main and "md5" in text


@pytest.fixture()
def own_embeddings(spark, folder):
    """A folder with 45 vectors, none of whose ids 100 divides."""
    rng = np.random.default_rng(5)
    made = [(i, rng.normal(size=8).tolist(), i % 3) for i in range(1, 46)]
    spark.createDataFrame(made, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


def by_sql(name, folder):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    return canonical(db.sql(plans.CHECKS[name]).df())


def test_recall_is_of_every_row(spark, own_embeddings):
    got = documents.ann_recall(spark, own_embeddings)
    assert tuple(got.first())[:2] == (45, 450)
    assert canonical(got.toPandas()).equals(by_sql("ann_recall", own_embeddings))


def test_every_row_is_asked_for_its_neighbours(spark, own_embeddings):
    got = documents.vector_topk(spark, own_embeddings).toPandas()
    assert set(got["vec_id"]) == set(range(1, 46)) and len(got) == 450
    assert canonical(got).equals(by_sql("vector_topk", own_embeddings))


def test_every_row_of_a_changed_index_is_asked(spark, own_embeddings):
    got = documents.served_index_topk(spark, own_embeddings).toPandas()
    assert set(got["vec_id"]) == {i for i in range(1, 46) if i % 7} and len(got) == 39 * 10
    assert canonical(got).equals(by_sql("served_index_topk", own_embeddings))


def test_the_hit_rate_is_of_every_row(spark, own_embeddings):
    got = documents.retrieval_hit_rate(spark, own_embeddings).toPandas()
    assert dict(zip(got["label"], got["n_queries"], strict=True)) == {0: 15, 1: 15, 2: 15}
    assert canonical(got).equals(by_sql("retrieval_hit_rate", own_embeddings))


def test_blocks_are_as_small_as_keeps_the_cores_busy():
    assert vectors._blocks(51_282, 51_282, 131_072, 12) == (4, 3)  # one task before
    assert vectors._blocks(1_000_000, 500_000, 131_072, 12) == (8, 4)
    assert vectors._blocks(500, 3_000, 131_072, 16) == (1, 1)
