"""Language of texts by a linear-chain conditional random field over their words.

Each word of a text gets a language. Its score for each comes from the word's affixes, its
character n-grams and a lexicon; learned transitions tie neighbouring words together, so that
stretches of another language in a text are told apart. Forward-backward gives each word's
exact chances given the whole text, and the text's language is the one with most of them.

Texts of any length are worked on side by side: words are cut into blocks, the blocks'
transfer matrices are multiplied in step, carried from block to block along each text, and
then each block is gone through once forward and once backward.

The field is trained on a bounded sample of labelled texts: ``TEXTS`` a language, a window
of ``WINDOW`` words of each, also joined across languages, so that switches are seen.

Defined results: NULL text and text without a letter is ``und`` with score 0, as is any text
if there is nothing to learn from. Rows are judged one by one, repeated rows alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.llm.tokens import character_tables, code_points, letter_table, point_hashes
from deskmill.session import materialized

#: The sample for training: texts of each language, words of each text.
TEXTS, WINDOW = 200, 60
#: Languages that are learned, and characters of a text of the sample.
LANGUAGES, LONGEST = 200, 200_000
#: Weights are kept by hash in a table of this many rows.
FEATURES = 1 << 16
#: A word is in a language's lexicon if the sample has it so often, and this share of it there.
LEXICON_COUNT, LEXICON_SHARE = 4, 0.8
ROUNDS = 60
BLOCK = 32
UNKNOWN = "und"

_RESULT = "doc_id long, held_out boolean, lang_pred string, score double, n_words long"


class Words:
    """Words of a slice of texts: letter runs, lower-cased, and the distinct ones among them."""

    def __init__(self, texts: pa.Array):
        lower, _, values = character_tables()
        points, rows = code_points(*arrays.utf8(texts))
        inside = letter_table()[points]
        self.points = lower[points]
        before, after = np.zeros(len(points), bool), np.zeros(len(points), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        begins, ends = rows[:-1], rows[1:]
        filled = ends > begins
        before[begins[filled]] = False
        after[ends[filled] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.stops = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, rows)
        self.values = values[self.points]
        self.hashes = point_hashes(self.values, self.starts, self.stops)
        self.distinct, self.example, self.which = np.unique(self.hashes, return_index=True, return_inverse=True)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashed features of the distinct words, and the word that each belongs to."""
        starts, stops = self.starts[self.example], self.stops[self.example]
        length = stops - starts
        word = np.repeat(np.arange(len(starts)), length)
        ends = np.cumsum(length)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - length), length)
        stop = stops[word]
        found, owner = [self.distinct], [np.arange(len(starts))]
        gram = np.full(len(at), 17, np.uint64)
        for n in (1, 2, 3):
            there = at + n <= stop
            gram, word, at, stop = gram[there], word[there], at[there], stop[there]
            gram = arrays.mixed(gram * np.uint64(0x9FB21C651E98DF25) + self.values[at + n - 1])
            found.append(gram)
            owner.append(word)
            for edge, salt in ((at == starts[word], 0x51), (at + n == stop, 0xA3)):  # affixes
                found.append(arrays.mixed(gram[edge] + np.uint64(salt)))
                owner.append(word[edge])
        return (np.concatenate(found) & np.uint64(FEATURES - 1)).astype(np.int64), np.concatenate(owner)


class Field:
    """A trained field: languages, feature weights, lexicon, and transition scores."""

    def __init__(self, languages: list[str]):
        k = len(languages)
        self.languages = languages
        self.weights = np.zeros((FEATURES, k), np.float32)
        self.lexicon = np.zeros(0, np.uint64)  # sorted hashes
        self.listed = np.zeros(0, np.int64)  # language of each
        self.listing = np.full(k, 1.0)  # what being listed adds
        self.transitions = np.where(np.eye(k, dtype=bool), 0.0, -3.0)
        self.start = np.zeros(k)

    def lexicon_rows(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.lexicon):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, distinct), len(self.lexicon) - 1)
        hit = np.flatnonzero(self.lexicon[at] == distinct)
        return hit, self.listed[at[hit]]

    def scores(self, words: Words) -> np.ndarray:
        """One row of scores for each distinct word."""
        return self.scores_of(*words.features(), words.distinct)

    def scores_of(self, feature: np.ndarray, owner: np.ndarray, distinct: np.ndarray) -> np.ndarray:
        n, k = len(distinct), len(self.languages)
        out = np.empty((n, k))
        for y in range(k):
            out[:, y] = np.bincount(owner, self.weights[feature, y], minlength=n)
        hit, language = self.lexicon_rows(distinct)
        out[hit, language] += self.listing[language]
        return out


def chances(emission: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Forward-backward: chances of each language for every word, given its whole text.

    Row r's words are ``first[r] .. first[r + 1]``; no text affects another. To ``pairs`` is
    added how often each pair of languages is expected in neighbouring words.
    """
    n, k = emission.shape
    if not n:
        return emission.copy()
    sizes = np.diff(first)
    blocks = -(-sizes // BLOCK)
    n_blocks = int(blocks.sum())
    row = np.repeat(np.arange(len(sizes)), blocks)
    order = np.arange(n_blocks) - np.repeat(np.cumsum(blocks) - blocks, blocks)  # block's place in its text
    begin = first[row] + order * BLOCK
    fill = np.minimum(BLOCK, first[row + 1] - begin)
    steps = np.arange(BLOCK)
    real = steps[None, :] < fill[:, None]
    local = np.exp(emission - emission.max(axis=1, keepdims=True))
    local = np.where(real[:, :, None], local[np.minimum(begin[:, None] + steps, n - 1)], 1.0)
    move = np.exp(transitions - transitions.max())
    opening = np.exp(start - start.max())
    opens = order == 0

    def apply(matrices: np.ndarray, step: int) -> np.ndarray:
        """One word further, for all blocks; places after a text's end change nothing."""
        new = matrices @ move
        if step == 0:
            new[opens] = matrices[opens].sum(axis=2, keepdims=True) * opening
        new = new * local[:, step, None, :]
        new /= new.sum(axis=(1, 2), keepdims=True)
        return np.where(real[:, step, None, None], new, matrices)

    transfer = np.broadcast_to(np.eye(k) / k, (n_blocks, k, k)).copy()
    for step in range(BLOCK):
        transfer = apply(transfer, step)

    # From block to block: what comes into each from the left, and from the right.
    left, right = np.full((n_blocks, k), 1.0 / k), np.full((n_blocks, k), 1.0 / k)
    at = np.cumsum(blocks) - blocks
    by_length = np.argsort(-blocks, kind="stable")
    counts = blocks[by_length]
    for b in range(1, int(blocks.max())):
        here = at[by_length[: int(np.searchsorted(-counts, -b, side="left"))]] + b
        new = np.einsum("ni,nij->nj", left[here - 1], transfer[here - 1])
        left[here] = new / new.sum(axis=1, keepdims=True)
    for b in range(int(blocks.max()) - 2, -1, -1):
        here = at[by_length[: int(np.searchsorted(-counts, -(b + 1), side="left"))]] + b
        new = np.einsum("nij,nj->ni", transfer[here + 1], right[here + 1])
        right[here] = new / new.sum(axis=1, keepdims=True)

    forward = np.empty((BLOCK, n_blocks, k))
    state = left
    for step in range(BLOCK):
        new = state @ move
        if step == 0:
            new[opens] = opening
        new = new * local[:, step]
        new /= new.sum(axis=1, keepdims=True)
        state = np.where(real[:, step, None], new, state)
        forward[step] = state
    state = right
    for step in range(BLOCK - 1, -1, -1):
        if pairs is not None:
            joint = (forward[step - 1] if step else left)[:, :, None] * move * (local[:, step] * state)[:, None, :]
            joint = joint[real[:, step] & ~(opens & (step == 0))]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        own = forward[step] * state
        forward[step] = own / own.sum(axis=1, keepdims=True)
        new = (state * local[:, step]) @ move.T
        new /= new.sum(axis=1, keepdims=True)
        state = np.where(real[:, step, None], new, state)
    return forward.transpose(1, 0, 2)[real]


# -- training ---------------------------------------------------------------------------------


def train(texts: list[str], labels: list[str], seed: int = 11, rounds: int = ROUNDS) -> Field | None:
    """A field fitted to labelled texts by gradient ascent on its likelihood."""
    words = Words(pa.array(texts, pa.string()))
    languages = sorted(set(labels))
    sizes = np.diff(words.first)
    if not languages or not sizes.sum():
        return None
    pick = np.random.default_rng(seed)
    field = Field(languages)
    k = len(languages)
    windows, truth = [], []
    for i, label in enumerate(labels):
        if sizes[i]:
            low = words.first[i] + int(pick.integers(0, max(1, sizes[i] - WINDOW + 1)))
            windows.append(np.arange(low, min(low + WINDOW, words.first[i + 1])))
            truth.append(languages.index(label))
    # Every word of a text counts for the lexicon.
    language_of = np.repeat([languages.index(label) for label in labels], sizes)
    table = np.zeros((len(words.distinct), k))
    np.add.at(table, (words.which, language_of), 1)
    share = table / np.maximum(1, table.sum(axis=0)) + 1e-9
    share /= share.sum(axis=1, keepdims=True)
    best = share.argmax(axis=1)
    listed = (table.max(axis=1) >= LEXICON_COUNT) & (share.max(axis=1) >= LEXICON_SHARE)
    field.lexicon, field.listed = words.distinct[listed], best[listed]

    # Sequences: windows as they are, and two halves of different texts joined.
    ids, ys = [], []
    for w, y in zip(windows, truth, strict=True):
        ids.append(w)
        ys.append(np.full(len(w), y))
        if pick.random() < 0.4:
            j = int(pick.integers(len(windows)))
            a, b = w[: len(w) // 2], windows[j][len(windows[j]) // 2 :]
            ids.append(np.concatenate([a, b]))
            ys.append(np.concatenate([np.full(len(a), y), np.full(len(b), truth[j])]))
    keep = [i for i, w in enumerate(ids) if len(w)]
    ids, ys = [ids[i] for i in keep], [ys[i] for i in keep]
    first = np.cumsum([0, *map(len, ids)])
    used, which = np.unique(words.which[np.concatenate(ids)], return_inverse=True)
    y, distinct = np.concatenate(ys), words.distinct[used]
    opens = np.zeros(len(y), bool)
    opens[first[:-1]] = True
    words.distinct, words.example = distinct, words.example[used]
    feature, owner = words.features()
    hit, hit_language = field.lexicon_rows(distinct)
    moments = [[0.0, 0.0] for _ in range(4)]
    inner = np.flatnonzero(~opens)
    seen = np.zeros((k, k))
    np.add.at(seen, (y[inner - 1], y[inner]), 1)
    for step in range(1, rounds + 1):
        scores = field.scores_of(feature, owner, distinct)
        expected = np.zeros((k, k))
        each = chances(scores[which], first, field.transitions, field.start, expected)
        miss = -each
        miss[np.arange(len(y)), y] += 1
        by_word = np.stack([np.bincount(which, miss[:, c], minlength=len(distinct)) for c in range(k)], axis=1)
        n = len(ids)
        slopes = [
            np.stack([np.bincount(feature, by_word[owner, c], minlength=FEATURES) for c in range(k)], axis=1) / n - 1e-4 * field.weights,
            np.bincount(hit_language, by_word[hit, hit_language], minlength=k) / n,
            (seen - expected) / n - 1e-3 * field.transitions,
            miss[opens].sum(axis=0) / n,
        ]
        for (value, slope), moment in zip(
            ((field.weights, slopes[0]), (field.listing, slopes[1]), (field.transitions, slopes[2]), (field.start, slopes[3])), moments, strict=True
        ):  # Adam
            moment[0] = moment[0] + 0.1 * (slope - moment[0])
            moment[1] = moment[1] + 0.02 * (slope * slope - moment[1])
            value += 0.1 * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.98**step)) + 1e-6)
    return field


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in arrays.slices(batches, "text"):
            words = Words(batch.column("text"))
            sizes = np.diff(words.first)
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if field is not None and sizes.sum():
                each = chances(field.scores(words)[words.which], words.first, field.transitions, field.start)
                full = np.flatnonzero(sizes)
                sums = np.add.reduceat(each, words.first[:-1][full], axis=0) / sizes[full][:, None]
                for row, best in zip(full, sums.argmax(axis=1), strict=True):
                    names[row] = field.languages[best]
                scores[full] = np.clip(sums.max(axis=1), 0.0, 1.0)
            made = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())]
            columns = [batch.column("doc_id"), batch.column("held_out"), *made]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "n_words"])

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """One document in five, by a check sum of its id; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def languages(docs: DataFrame, texts: int = TEXTS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, n_words`` for every row of ``docs(doc_id, text, lang)``.

    Learns from rows that have a language and an id and are not held out: ``texts`` different texts
    of each of the ``LANGUAGES`` languages with most of them, shorter ones than ``LONGEST`` if there
    are, and no more than that of any. Copies of a text, and repeated rows, count as one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    docs = docs.withColumn("held_out", held_out())
    known = docs.filter("NOT held_out AND doc_id IS NOT NULL AND lang IS NOT NULL AND length(text) > 20")
    # Copies of a text count once, so that the sample is of different texts.
    hashed = known.select("lang", F.xxhash64("text").alias("hash"), (F.length("text") > LONGEST).alias("long"), "doc_id")
    texts_of = materialized(hashed.groupBy("lang", "hash").agg(F.min("doc_id").alias("doc_id"), F.bool_or("long").alias("long")), "texts")
    most = texts_of.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    order = ["long", F.xxhash64("doc_id", "hash"), "doc_id", "hash"]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    keys = texts_of.join(F.broadcast(most), "lang").withColumn("_n", rank).filter(F.col("_n") <= texts).select("lang", "hash", "doc_id")
    keys = materialized(keys, "sample")  # at most LANGUAGES times ``texts`` rows
    found = known.withColumn("hash", F.xxhash64("text")).join(F.broadcast(keys), ["lang", "hash", "doc_id"])
    rows = found.groupBy("lang", "hash", "doc_id").agg(F.min(F.left("text", F.lit(LONGEST))).alias("text")).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"], r["lang"]))
    field = train([r["text"] for r in rows], [r["lang"] for r in rows])
    shared = docs.sparkSession.sparkContext.broadcast(field)
    return docs.select("doc_id", "text", "held_out").mapInArrow(_predict(shared), _RESULT)
