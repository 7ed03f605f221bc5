"""Small tables with the awkward cases that every operator must stand."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, row string, digest string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def texts(seed=1):
    """Copies, near copies, shared passages, nulls, white space, controls, repetitions and a long text."""
    rnd = random.Random(seed)
    out = []
    for _ in range(5):
        base = sentence(rnd, rnd.randint(40, 90)).split()
        for _ in range(rnd.choice([2, 3, 12])):
            words = list(base)
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(999)}"
            out.append(" ".join(words))
    passage = sentence(rnd, 40)
    out += [f"{sentence(rnd, rnd.randint(0, 30))} {passage} {sentence(rnd, rnd.randint(0, 30))}" for _ in range(12)]
    out += [None, None, "", " \t\n", "a", "A", "a  b\nc ", "one two three four five", "é ß 漢字 \x1f\x85 z", "\0" * 120, "same " * 60]
    out += ["line one here\nline one here\n\nother\n", "<|endoftext|> ### Assistant: </turn> \\", "ab" * 150, sentence(rnd, 6000)]
    out += out[:3] + [out[0].replace(" ", "  "), out[1].upper()]
    return out


def documents(spark, seed=1):
    """Rows with extra columns whose names operators use too; two rows repeat, two have no identifier, one source is null."""
    rows = []
    for i, text in enumerate(texts(seed)):
        rows.append((i, text, "en", None if i % 11 == 0 else f"s{i % 4}", 7, -1, None, "r", "d"))
    rows += [rows[3], rows[-1], (None, "nobody's text of some words", None, None, None, None, None, None, None)]
    rows += [(None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    """Distinct rows without doc_id by doc_id."""
    found = {}
    for row in df.collect():
        values = row.asDict()
        key = values.pop("doc_id")
        assert found.setdefault(key, values) == values
    return found
