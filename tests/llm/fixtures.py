"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sentence(rng, n, vocab=40):
    return " ".join(f"w{rng.randrange(vocab)}é" if rng.random() < 0.1 else f"W{rng.randrange(vocab)}" for _ in range(n))


def corpus(seed=3):
    """(doc_id, text, source) rows."""
    rng = random.Random(seed)
    passage = sentence(rng, 60, 500)
    rows = [(None, passage, "a"), (None, None, None), (1, None, "b"), (2, "", "b"), (3, "  \n\t ", "a"), (4, "one", "a"),
            (5, "One", "c"), (6, "x" * 300 + " y\u00a0z \x00 q", "a")]
    for k in range(10, 60):
        rows.append((k, sentence(rng, rng.randrange(5, 120), 300), f"s{k % 3}"))
    for k in range(60, 80):
        words = (passage + " " + sentence(rng, 30, 500)).split(" ")
        rows.append((k, "\n".join([" ".join(words[:20]), " ".join(words[20:])]), "s1"))
    base = sentence(rng, 200, 900).split(" ")
    for k in range(80, 110):  # near copies, each with a few words changed
        words = list(base)
        for _ in range(rng.randrange(1, 8)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(9999)}"
        rows.append((k, " ".join(words), "hot"))
    rows += [rows[20], rows[20], (10, passage, "s0"), (200, rows[30][1], "hot"), (201, rows[30][1].upper(), "hot")]
    rows.append((300, " ".join(f"long{i % 700}" for i in range(30_000)), "hot"))
    rng.shuffle(rows)
    return rows


def documents(spark, rows):
    """The rows with columns whose names the operators' results have too."""
    names = "doc_id long, text string, source string, n_words string, kept string, dedup string, rules string, mix string, contamination string"
    return spark.createDataFrame([(*r, "x", "y", None, "z", "m", "c") for r in rows], names)


def empty(spark):
    return documents(spark, [])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
