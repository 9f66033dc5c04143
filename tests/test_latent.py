"""Vectors by a truncated SVD of hashed tf-idf."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from deskmill.operators import latent

TOPICS = {
    "river": "river boat water fish bank flow stream ferry",
    "music": "song tune drum violin chord choir rhythm melody",
    "bread": "flour oven dough yeast crust loaf baker salt",
}


def corpus(spark, n=120):
    rng = random.Random(11)
    made = []
    for i in range(n):
        topic = sorted(TOPICS)[i % 3]
        words = rng.sample(TOPICS[topic].split(), 3) + rng.choices("the of and in on it was for".split(), k=6)
        made.append((i, topic, " ".join(words)))
    return spark.createDataFrame([*made, (1000, "none", None), (1001, "none", ""), (None, "none", " ;; ")], "id long, topic string, text string")


def dense(rows, features, weights):
    out = np.zeros((len(rows), features))
    for i, r in enumerate(rows):
        for f, t in zip(r.feature, r.times, strict=True):
            out[i, f] = (1 + np.log(t)) * weights[f]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1)


def test_directions_are_those_of_a_full_svd(spark):
    rows = latent.featured(corpus(spark).repartition(5), ["id", "topic"], "text", 64)
    model = latent.fit(rows, 64, 3, passes=12)
    collected = rows.collect()
    matrix = dense(collected, 64, latent.feature_weights(rows, 64))
    _, values, directions = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(model.strengths, values[:3], rtol=1e-6)
    assert np.allclose(np.abs((directions[:3] * model.directions.T).sum(axis=1)), 1, atol=1e-6)
    assert (model.directions[np.abs(model.directions).argmax(axis=0), range(3)] > 0).all()
    got = {r.id: r.vector for r in latent.latent_vectors(rows, ["id"], model).collect()}
    plain = matrix @ model.directions
    for r, v in zip(collected, plain, strict=True):
        length = np.linalg.norm(v)
        assert np.allclose(got[r.id], v / length if length > 1e-12 else 0 * v, atol=1e-9)
    again = latent.fit(rows, 64, 3, passes=12)
    assert np.allclose(again.directions, model.directions, atol=1e-6)


def test_texts_of_a_topic_are_nearer_than_chance(spark):
    rows = latent.featured(corpus(spark), ["id", "topic"], "text", 512)
    vectors = latent.latent_vectors(rows, ["id", "topic"], latent.fit(rows, 512, 4))
    found = {r.topic: r for r in latent.likeness(vectors, "topic", 4).collect()}
    assert set(found) == set(TOPICS)
    for r in found.values():
        assert r.texts == 40 and r.within > r.chance + 0.1
    # Against all pairs, one by one.
    own = np.array([r.vector for r in vectors.filter(F.col("topic") == "river").collect()])
    assert abs(found["river"].within - (own @ own.T).mean()) < 1e-9


def test_tables_without_rows_or_words(spark):
    none = corpus(spark).limit(0)
    rows = latent.featured(none, ["id"], "text", 32)
    model = latent.fit(rows, 32, 2)
    assert latent.latent_vectors(rows, ["id"], model).count() == 0
    blank = latent.featured(corpus(spark).filter("topic = 'none'"), ["id"], "text", 32)
    vectors = latent.latent_vectors(blank, ["id"], latent.fit(blank, 32, 2))
    assert [r.vector for r in vectors.collect()] == [[0.0, 0.0]] * 3
    assert latent.likeness(vectors.withColumn("g", F.lit(1)), "g", 2).count() == 0


def test_tokens_of_a_batch_are_counted_in_pieces(monkeypatch):
    rng = random.Random(2)
    texts = [[rng.randrange(16) for _ in range(rng.randrange(40))] for _ in range(200)] + [None, [], [3] * 900]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.list_(pa.int32()))], ["id", "feature"])
    whole = [r for b in latent._count(16)(iter([batch])) for r in b.to_pylist()]
    monkeypatch.setattr(latent, "TOKENS", 100, raising=False)
    flat, seen = latent._flat, []
    monkeypatch.setattr(latent, "_flat", lambda lists: seen.append(len(lists.flatten())) or flat(lists))
    assert [r for b in latent._count(16)(iter([batch])) for r in b.to_pylist()] == whole
    assert sorted(seen)[-1] == 900 and sorted(seen)[-2] <= 100
    for r, text in zip(whole, texts, strict=True):
        assert dict(zip(r["feature"], r["times"], strict=True)) == {f: text.count(f) for f in set(text or [])}
