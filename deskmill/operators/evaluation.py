"""Scores for answers, retrieval and feedback.

The scores are plain counts of tokens, terms and sentences. They stand in for judgements
that a language model would give and do not claim to agree with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.functions.text import sentences, term_matches, tokens
from deskmill.operators.skew import with_next
from deskmill.session import materialized

# Words an answer must not hold.
BLOCKED_TERMS = ("idiot", "clown", "worthless", "stupid", "moron")
MAX_SENTENCES = 2


def answered_turns(turns: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """``(conv_id, turn, question, answer)`` for user turns that an assistant's follows.

    The next turn is the next there is, whatever its number; ``order`` names columns that
    order rows of one turn. A long conversation is gone through in blocks of its turns.
    """
    ways = [*order, "role", "text"]
    found = with_next(turns, ["conv_id"], "turn", ways, F.struct("role", "text"), "next")
    return found.filter((F.col("role") == "user") & (F.col("next.role") == "assistant")).select(
        "conv_id", "turn", F.col("text").alias("question"), F.col("next.text").alias("answer")
    )


def relevance(question: Column, answer: Column) -> Column:
    """The share of the question's distinct tokens that the answer holds."""
    wanted = F.array_distinct(tokens(question))
    shared = F.size(F.array_intersect(wanted, tokens(answer)))
    return F.when(F.size(wanted) == 0, F.lit(0.0)).otherwise(F.round(shared / F.size(wanted), 6))


def is_flagged(text: Column) -> Column:
    return term_matches(text, BLOCKED_TERMS) > 0


def style_ok(text: Column, most: int = MAX_SENTENCES) -> Column:
    return F.size(sentences(text)) <= most


def score_safety(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Flagged texts against the reviewers' label; ``toxic`` is NULL where none was given."""
    rows = documents.select("doc_id", is_flagged(F.col("text")).alias("flagged"))
    return (
        rows.join(labels.select("doc_id", "toxic"), "doc_id", "left")
        .groupBy("toxic")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("flagged").alias("n_flagged"))
        .withColumn("safe_rate", F.round(1 - F.col("n_flagged") / F.col("n_docs"), 6))
    )


def evaluate_answers(pairs: DataFrame) -> DataFrame:
    """Every pair under every scorer, and a row with the mean per scorer.

    ``(conv_id, turn, scorer, score)``; the means have NULL ids. Texts are scored once, and
    the scores, a few numbers a pair, written; rows that share their ids stay rows.
    """
    scored = pairs.select(
        "conv_id",
        "turn",
        relevance(F.col("question"), F.col("answer")).alias("relevance"),
        (~is_flagged(F.col("answer"))).cast("double").alias("safety"),
        style_ok(F.col("answer")).cast("double").alias("style"),
    )
    scored = materialized(scored, "scores")
    long = scored.unpivot(["conv_id", "turn"], ["relevance", "safety", "style"], "scorer", "score")
    means = long.groupBy("scorer").agg(F.round(F.avg("score"), 6).alias("score"))
    none = [F.lit(None).cast(long.schema[c].dataType).alias(c) for c in ("conv_id", "turn")]
    return long.unionByName(means.select(*none, "scorer", "score"))


def retrieval_hit_rate(found: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """How often one of the best ``k`` has the query's label, per label.

    ``found(query_id, id)`` and ``labels(id, label)``.
    """
    mine = labels.select(F.col("id").alias("query_id"), F.col("label").alias("query_label"))
    judged = found.join(labels, "id").join(mine, "query_id")
    per_query = judged.groupBy("query_id", "query_label").agg(
        F.count_if(F.col("label") == F.col("query_label")).alias("good"), F.count(F.lit(1)).alias("n")
    )
    return per_query.groupBy(F.col("query_label").alias("label")).agg(
        F.lit(k).alias("k"),
        F.count(F.lit(1)).alias("n_queries"),
        F.count_if(F.col("good") > 0).alias("n_hits"),
        F.round(F.count_if(F.col("good") > 0) / F.count(F.lit(1)), 6).alias("hit_rate"),
        F.round(F.sum("good") / F.sum("n"), 6).alias("precision_at_k"),
    )


def feedback_summary(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled share, good share and toxic share per source; rates are over labelled rows."""
    return (
        documents.select("doc_id", "source")
        .join(labels, "doc_id", "left")
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.count("quality").alias("n_labelled"),
            F.round(F.count("quality") / F.count(F.lit(1)), 6).alias("labelled_share"),
            F.round(F.avg("quality"), 6).alias("quality_rate"),
            F.round(F.avg("toxic"), 6).alias("toxic_rate"),
        )
    )


def style_check(turns: DataFrame, most: int = MAX_SENTENCES) -> DataFrame:
    n = F.size(sentences(F.col("text")))
    return turns.select("conv_id", "turn", n.alias("n_sentences"), (n <= most).alias("style_ok"))


def history_answers(history: DataFrame) -> DataFrame:
    """One sentence per category and one with the total, as text, per customer."""
    line = F.concat(
        F.format_number("n", 0), F.lit(" contacts about "), F.col("issue_category")
    ).alias("line")
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("issue_category", line))), lambda s: s["line"]),
        "\n",
    )
    rows = history.withColumn("n", F.col("returns_last_12_months").cast("bigint"))
    total = F.format_number(F.sum("n"), 0)
    return rows.groupBy("email").agg(
        F.concat(body, F.lit("\nIn all, a total of "), total, F.lit(" contacts")).alias("answer")
    )


def expected_total_check(answers: DataFrame) -> DataFrame:
    """Do the numbers of an answer add up to the total it states?"""

    def number(text: Column) -> Column:
        return F.replace(text, F.lit(","), F.lit("")).try_cast("bigint")

    parts = F.regexp_extract_all("answer", F.lit(r"(?m)^([0-9,]+) \w+"), F.lit(1))
    added = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, p: acc + number(p))
    stated = number(F.regexp_extract("answer", r"total of ([0-9,]+)", 1))
    return answers.select(
        "email",
        "answer",
        added.alias("added"),
        stated.alias("stated"),
        F.coalesce(added == stated, F.lit(False)).alias("consistent"),
    )
