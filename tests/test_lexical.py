"""Retrieval by words, and fusion of ranked lists."""

import collections
import math
import random
import re

from conftest import plan, rows

from deskmill.operators import lexical


def plain(corpus, question, k):
    words = {uri: re.findall("[a-z]+", (text or "").lower()) for uri, text in corpus}
    texts = {uri: found for uri, found in words.items() if found}
    mean = sum(map(len, texts.values())) / len(texts)
    df = collections.Counter(t for words in texts.values() for t in set(words))
    scores = {}
    for uri, words in texts.items():
        counts = collections.Counter(words)
        found = [t for t in set(question.lower().split()) if counts[t]]
        if found:
            idf = {t: math.log((len(texts) - df[t] + 0.5) / (df[t] + 0.5) + 1) for t in found}
            scores[uri] = round(sum(idf[t] * counts[t] * 2.2 / (counts[t] + 1.2 * (0.25 + 0.75 * len(words) / mean)) for t in found), 6)
    return sorted(((-score, uri) for uri, score in scores.items()))[:k]


def test_bm25_against_a_plain_version(spark, folder):
    rng = random.Random(4)
    corpus = [(f"d{i:03d}", " ".join(rng.choices("river house field mill boat rain the the the".split(), k=rng.randrange(1, 30)))) for i in range(150)]
    corpus += [("e1", None), ("e2", ""), ("e3", "?!"), ("e4", "the " * 500)]
    questions = [(1, "river boat boat"), (2, "The mill"), (3, "absent"), (4, ""), (5, None)]
    lexical.write_index(spark.createDataFrame(corpus, "uri string, text string"), f"{folder}/index")
    got = lexical.search(spark, f"{folder}/index", spark.createDataFrame(questions, "query_id int, text string"), 7)
    want = [(q, uri, -score, r) for q, text in questions if text for r, (score, uri) in enumerate(plain(corpus, text, 7), 1)]
    assert sorted((r["query_id"], r["uri"], r["score"], r["rank"]) for r in got.collect()) == sorted(want)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_an_index_of_nothing(spark, folder):
    lexical.write_index(spark.createDataFrame([("a", None)], "uri string, text string"), f"{folder}/index")
    assert lexical.search(spark, f"{folder}/index", spark.createDataFrame([(1, "a")], "query_id int, text string"), 3).collect() == []


def test_fusion_prefers_what_both_lists_hold(spark):
    schema = "query_id int, uri string, rank int"
    one = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "z", 1)], schema)
    two = spark.createDataFrame([(1, "c", 1), (1, "d", 2)], schema)
    got = lexical.fused([one, two], 3).select("query_id", "uri", "n_lists", "rank")
    assert rows(got) == [(1, "a", 1, 2), (1, "b", 1, 3), (1, "c", 2, 1), (2, "z", 1, 1)]


def test_blocks_keep_a_document_together_and_questions_come_in_parts(spark, folder, monkeypatch):
    rng = random.Random(9)
    vocabulary = "river house field mill boat rain the a of".split()
    corpus = [(f"d{i:03d}", " ".join(rng.choices(vocabulary, k=rng.randrange(1, 12)))) for i in range(120)]
    corpus += [("same", "river mill boat")] * 25 + [("same", "river"), (None, "mill"), (None, "boat mill")]
    corpus += [(f"copy{i:02d}", "mill mill rain") for i in range(30)]
    questions = [(i, " ".join(rng.sample(vocabulary, 3))) for i in range(20)] + [(None, "mill")]
    texts = spark.createDataFrame(corpus, "uri string, text string").repartition(4)
    asked = spark.createDataFrame(questions, "query_id int, text string")
    lexical.write_index(texts, f"{folder}/whole")
    whole = lexical.search(spark, f"{folder}/whole", asked, 8).collect()
    for name, value in (("ROWS", 7), ("ASKED", 9), ("QUESTIONS", 2)):
        monkeypatch.setattr(lexical, name, value)
    lexical.write_index(texts, f"{folder}/cut")
    blocks = spark.read.parquet(f"{folder}/cut/postings").collect()
    held = [u for b in blocks for u in b["uris"]]
    assert len(held) == len(set(held)) == 152 and len(blocks) > 10
    assert sorted(map(str, lexical.search(spark, f"{folder}/cut", asked, 8).collect())) == sorted(map(str, whole))
    tf = collections.Counter((u, len(t.split()), w) for u, t in corpus for w in t.split())
    mean = sum(len(t.split()) for _, t in corpus) / len(corpus)
    df = collections.Counter(w for _, _, w in tf)
    for q, question in questions:
        scores = collections.Counter()
        for (u, n, w), times in tf.items():
            if w in question.split():
                idf = math.log((len(corpus) - df[w] + 0.5) / (df[w] + 0.5) + 1)
                scores[u] += idf * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * n / mean))
        want = sorted((-round(s, 6), u is not None, u) for u, s in scores.items())[:8]
        assert sorted((-r["score"], r["uri"] is not None, r["uri"]) for r in whole if r["query_id"] == q) == want


def test_postings_are_not_shuffled(spark, folder):
    """Shuffled are texts, by URI, and the best of each block; before, postings were, three times."""
    texts = spark.createDataFrame([(f"d{i}", "a b c") for i in range(50)], "uri string, text string")
    lexical.write_index(texts, folder)
    got = plan(lexical.search(spark, folder, spark.createDataFrame([(1, "a")], "query_id int, text string"), 3))
    assert "Join" not in got and "postings" not in got
