"""Quality rules combined by weak supervision.

Every rule looks at counts of a whole text and votes good (1), bad (-1) or abstains (0).
Expectation-maximisation estimates from the agreement of the votes how often
each rule is right and how many documents are good; a document is kept when
its posterior probability of being good reaches a half. Two base rules drop a document whatever
the votes say.

Documents are counted by their pattern of votes first, at most ``3 ** rules`` rows
whatever the input, and every iteration is one aggregation over that table.
All counts of a document are array functions over its own row: no row per word is
made and nothing is shuffled but the patterns.

Null and empty texts have zero counts and fail the base rule; very long texts cost
``n log n``; repeated rows are judged alike and counted each; an empty table gives an empty result. Only ``doc_id`` and
``text`` are read, and ``filter_documents`` passes all other columns through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikelens.llm.common import SPACE, WORD, row_key, whole_text
from strikelens.runtime import stage

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words

ITERATIONS = 25
#: Where every rule starts: the chance of each vote for a good and for a bad document. Votes keep their direction, so "good" keeps its meaning.
#: A bad document is caught by few of the rules, as each looks for its own fault.
START = {1: (0.9, 0.7), 0: (0.09, 0.1), -1: (0.01, 0.2)}
PRIOR = 20.0
#: No rule calls more than this share of the good documents bad; what exceeds it is evidence of bad documents.
MOST_WRONG = 0.02


def counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each text. Each step is a projection of its own, since later ones use it several times."""
    text = whole_text()
    plain = F.regexp_replace(text, SPACE + "+", "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    size_without = lambda characters: F.char_length("plain") - F.char_length(F.translate("plain", characters, ""))
    cut = docs.select(
        "doc_id",
        plain.alias("plain"),
        F.regexp_extract_all(text, F.lit(WORD), 0).alias("words"),
        lines.alias("lines"),
    )
    measured = cut.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length("plain").cast("long").alias("word_chars"),
        size_without(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        size_without("!").alias("n_shouts"),
        size_without("|").alias("n_bars"),
        F.char_length(F.regexp_replace("plain", r"\P{L}+", "")).alias("n_letters"),
        F.char_length(F.regexp_replace("plain", r"\P{Lu}+", "")).alias("n_capitals"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    at = lambda i, k: F.element_at("hashes", (i + k).cast("int"))
    windows = F.when(
        F.size("hashes") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("hashes") - WINDOW + 1), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])),
    )
    echoes = F.size(F.filter("hashes", lambda h, i: (i > 0) & (F.get("hashes", F.greatest(i - 1, F.lit(0))) == h)))
    windowed = measured.withColumns({"windows": windows, "n_echoes": echoes}).drop("hashes")
    # only texts with a repeated window sort theirs with their places
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = windowed.withColumn("placed", F.when(repeated, placed)).drop("windows")
    same = lambda x, j: (
        (F.get("placed", j + 1)["h"] == x["h"]) | ((j > 0) & (F.get("placed", F.greatest(j - 1, F.lit(0)))["h"] == x["h"]))
    )
    starts = F.array_sort(F.transform(F.filter("placed", lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"]))
    found = ordered.withColumn("starts", starts).drop("placed")
    n = F.size("starts")
    steps = F.zip_with(
        F.slice("starts", F.lit(1), n - 1), F.slice("starts", F.lit(2), n - 1), lambda a, b: F.least(b - a, F.lit(WINDOW))
    )
    covered = F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step)
    return found.withColumn("n_repeat_words", F.when(F.col("starts").isNull(), 0).otherwise(covered).cast("long")).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))



def votes() -> dict[str, Column]:
    """The rules, by name. Between the two bounds a rule abstains."""
    per_word = lambda name: F.col(name) / F.greatest(F.col("n_words"), F.lit(1))
    per_char = lambda name: F.col(name) / F.greatest(F.col("word_chars"), F.lit(1))
    below = lambda x, good, bad: F.when(x <= good, 1).when(x > bad, -1).otherwise(0)
    length = per_char("word_chars") * F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    capitals = F.col("n_capitals") / F.greatest(F.col("n_letters"), F.lit(1))
    return {
        "length": F.when(F.col("n_words") >= 50, 1).when(F.col("n_words") < LEAST_WORDS, -1).otherwise(0),
        "word_length": F.when(length.between(3, 10), 1).when((length < 2) | (length > 14), -1).otherwise(0),
        "symbols": below(per_word("n_symbols"), 0.05, 0.3),
        "tables": below(per_word("n_bars"), 0.02, 0.15),
        "shouting": below(per_word("n_shouts"), 0.05, 0.3),
        "capitals": below(capitals, 0.15, 0.3),
        "letters": F.when(per_char("n_letters") >= 0.85, 1).when(per_char("n_letters") < 0.7, -1).otherwise(0),
        "lines": below(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.1, 0.3),
        "echoes": below(per_word("n_echoes"), 0.1, 0.3),
        "repeats": below(per_word("n_repeat_words"), 0.1, MOST_REPEATED / 100),
    }


def start(names: list[str]) -> dict[str, dict[int, tuple[float, float]]]:
    """Per rule and vote, the probability of the vote for a good and for a bad document."""
    return {x: dict(START) for x in names}


def _posterior(chances: dict[str, dict[int, tuple[float, float]]], good_share: float) -> Column:
    """Probability of good, given the votes; rules are independent given the truth."""
    evidence = F.lit(math.log(good_share / (1 - good_share)))
    for name, by_vote in chances.items():
        ratio = {vote: math.log(good / bad) for vote, (good, bad) in by_vote.items()}
        evidence = evidence + F.when(F.col(name) == 1, ratio[1]).when(F.col(name) == -1, ratio[-1]).otherwise(ratio[0])
    return 1 / (1 + F.exp(-evidence))


def accuracies(chances: dict[str, dict[int, tuple[float, float]]], good_share: float) -> dict[str, float]:
    """How often a rule is right when it votes."""
    found = {}
    for name, by_vote in chances.items():
        right = good_share * by_vote[1][0] + (1 - good_share) * by_vote[-1][1]
        wrong = good_share * by_vote[-1][0] + (1 - good_share) * by_vote[1][1]
        found[name] = right / (right + wrong)
    return found


def fit(patterns: DataFrame, names: list[str], iterations: int = ITERATIONS) -> tuple[dict, float]:
    """Chances of the votes and the share of good documents, from (votes..., n)."""
    chances, share = start(names), 0.8
    for _ in range(iterations):
        weighted = patterns.withColumn("p", _posterior(chances, share))
        of_vote = [
            F.sum(F.when(F.col(x) == vote, F.col("n") * side).otherwise(0)).alias(f"{x} {vote} {k}")
            for x in names
            for vote in (1, 0, -1)
            for k, side in enumerate((F.col("p"), 1 - F.col("p")))
        ]
        row = weighted.agg(*of_vote, F.sum("n").alias("total"), F.sum(F.col("n") * F.col("p")).alias("good")).first()
        if not row["total"]:
            break
        sides = (row["good"], row["total"] - row["good"])
        updated = {}
        for x in names:
            # imagined documents, PRIOR of each side, keep rare votes from becoming proofs
            seen = {
                vote: [(row[f"{x} {vote} {k}"] + PRIOR * START[vote][k]) / (sides[k] + PRIOR) for k in (0, 1)] for vote in START
            }
            # a vote for good never speaks for bad, nor the other way round
            (g1, b1), (g0, b0), (g2, b2) = seen[1], seen[0], seen[-1]
            updated[x] = {1: (max(g1, b1), min(g1, b1)), 0: (g0, g0) if g1 < b1 or b2 < g2 else (g0, b0), -1: (min(g2, b2, MOST_WRONG), max(g2, b2))}
        new_share = min(0.99, max(0.01, (row["good"] + 1) / (row["total"] + 2)))
        moved = abs(new_share - share)
        chances, share = updated, new_share
        if moved < 1e-7:
            break
    return chances, share


def judge(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """The counts of every document, its votes, posterior, base_failed and kept."""
    rules = votes()
    names = list(rules)
    counted = counts(docs).withColumns({"base_failed": base_failed()} | rules)
    counted = stage(counted, "quality-votes")
    patterns = stage(counted.groupBy(*names).agg(F.count("*").alias("n")), "vote-patterns").coalesce(1)
    posterior = _posterior(*fit(patterns, names, iterations))
    return counted.withColumn("posterior", posterior).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def filter_documents(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``."""
    judged = judge(docs.select(row_key().alias("doc_id"), "text"), iterations)
    kept = judged.filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), row_key().alias("_key"))
    return rows.join(kept, F.col("_key") == F.col("_kept"), "left_semi").select("_row.*")
