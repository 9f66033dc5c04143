"""Main text of hand-written pages, broken markup in linear time, and samples under repeated rows."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskmill.llm import language, pages

SF_DIR = "/root/testdata/sf0.001"
P = "The river was wide, and the boats went slowly past the old mill. Nobody spoke for a long while, as the evening came."
Q = "Later they walked home along the field, talking of the harvest, the weather and what the winter would bring."

#: Pages and their main text.
HAND = [
    (f"<html><body><nav><a href=/>Home</a> <a href=/x>News</a></nav><article><h1>Title here</h1><p>{P}</p><aside>Advert here</aside>"
     f"<form>Sign up</form><p>{Q}</p><section class=comments>First!</section></article><footer>Copyright</footer></body></html>", f"Title here\n{P}\n{Q}"),
    (f"<html><body><p>{P}</p></body></html>", P),
    (P, P),
    (f"<body><div class='story'><h1>A title</h1><p>{P}</p><ul><li>one thing, then</li><li>another thing</li></ul><pre>code of some kind</pre>"
     f"<table><tr><td>cell one</td><td>cell two</td></tr></table><blockquote>{Q}</blockquote></div></body>",
     f"A title\n{P}\none thing, then\nanother thing\ncode of some kind\ncell one\ncell two\n{Q}"),
    (f"<body><div class='post-content'><p>{P}</p><p>{Q}</p></div><div class='sidebar'><ul><li><a href=/a>More news</a></li></ul></div></body>", f"{P}\n{Q}"),
    (f"<body><header><a href=/>Site</a></header><main><h2>Head</h2><p>{P}</p><div class=ad>Buy now</div><p>{Q}</p></main>"
     f"<aside>Related</aside><footer>Legal</footer></body>", f"Head\n{P}\n{Q}"),
    (f"<body><div id=cookie-notice><p>We use cookies.</p><button>OK</button></div><article><p>{P}</p></article></body>", P),
    (f"<body><h1>Lone</h1><p>{P}</p><p>{Q}</p></body>", f"Lone\n{P}\n{Q}"),
    (f"<body><article><p>{P}</p><div class=comments><div class=comment><p>Great read, thanks for this!</p></div>"
     f"<div class=comment><p>I do not agree at all.</p></div></div></article></body>", P),
    (f"<body><article><p>{P}</p><form action=/s><label>Your mail</label><input><p>Get our letter every week</p></form></article></body>", P),
    (f"<body><nav><ul><li><a href=/>A</a></li></ul></nav><section><p>{P}</p><p>{Q}</p></section><footer><p>All rights reserved</p></footer></body>", f"{P}\n{Q}"),
    (f"<body><article><h1>T</h1><p>{P}</p><script>var a='<p>no</p>'</script><style>p{{}}</style><p>{Q}", f"T\n{P}\n{Q}"),
]


def test_hand_written_pages_come_out_exactly(spark):
    given = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    hand = spark.createDataFrame([(10_000 + i, "u", source) for i, (source, _) in enumerate(HAND)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.main_text(given.unionByName(hand)).collect()}
    assert [got[10_000 + i] for i in range(len(HAND))] == [text for _, text in HAND]
    for row in given.collect():  # the given pages mark their article, which holds nothing else
        tree = pages.Tree(pages._ARTICLE.search(row["html"])[0])
        assert got[row["page_id"]] == tree.text(np.ones(len(tree.parent), bool))


@pytest.mark.parametrize(
    "source",
    [
        "<b " + " ".join(f'k{i}="v"' for i in range(10_000)),
        "<p>x a <b " + "'tis \"so " * 20_000,
        '<b k="v>"' * 20_000,
        "<b k" * 50_000,
        "<div>" * 8000 + "</span>" * 8000,
        "<span><div>" + "<i>" * 8000 + "</span>" * 8000,
        "<!--" * 50_000,
        "<li>" * 20_000 + "</ul>" * 20_000,
    ],
)
def test_broken_markup_takes_linear_time(source):
    begin = time.perf_counter()
    pages.Tree(source)
    assert time.perf_counter() - begin < 2


def text_of(source):
    tree = pages.Tree(source)
    return tree.text(np.ones(len(tree.parent), bool))


def test_quotes_and_ends_of_tags():
    assert text_of('<p title="a > b">one</p><p class=x>two<br>three') == "one\ntwo three"
    assert text_of("<p>5 < 6 and <b 'tis>so</b></p>") == "5 < 6 and so"
    assert text_of('<p>one</p><p title="never closed>two</p><p>three</p>') == "one\ntwo\nthree"
    assert text_of("<p>one</p><p class=") == "one"
    assert text_of("<div>a</span>b<i>c</div>d") == "abc\nd"
    assert text_of("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == "a\nb\nc\nd"


def test_one_text_repeated_is_learned_once(spark, monkeypatch):
    rng = random.Random(5)
    words = {"en": "the and river house with from over green".split(), "de": "der und Fluss Haus mit von über grün".split()}
    rows = [(i, " ".join(rng.choices(words[lang], k=30)), lang) for i, lang in enumerate(["en", "de"] * 150)]
    rows += [(1000 + i, "the same text again and again and again", "en") for i in range(500)]  # one text, many ids
    rows += [(7, "one row that was written very often, the and over", "en")] * 1500
    rows += [(3000 + i, "words of a language of its own " * 3, f"x{i}") for i in range(6)]
    rows.append((5000, "the and river " * 100_000, "en"))
    learned = []
    train = language.train
    monkeypatch.setattr(language, "train", lambda texts, langs: learned.append((texts, langs)) or train(texts, langs))
    monkeypatch.setattr(language, "LANGUAGES", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = language.languages(docs, texts=60).collect()
    [(texts, langs)] = learned
    assert len(got) == len(rows) and len(texts) <= 120 and set(langs) == {"en", "de"}
    assert len(set(texts)) == len(texts) and max(map(len, texts)) <= language.LONGEST
    right = [r for r in got if r["doc_id"] < 300 and r["held_out"]]
    truth = {i: lang for i, _, lang in rows[:300]}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in right]) > 0.95
    again = {tuple(r) for r in language.languages(docs.orderBy(F.rand(3)), texts=60).collect()}
    assert again == {tuple(r) for r in got}
