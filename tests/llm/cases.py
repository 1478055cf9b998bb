"""Documents every operator has to take: nulls, empty and very long texts, repeated rows, odd characters."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
WORDS = "the of and to in that is was he for it with as his on be at by had not are but from or have an".split()


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "ing", "ed", "ly"]) for _ in range(n)) + "."


def documents():
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "a b c d", "a b c d e", prose(1), prose(1), prose(2), LONG,
        "naïve café —     \U0001f600 日本語 \x1c\x1d\x85 'S it's 123４５", "x" * 5000, "#*$%&|<>" * 20,
        "same line\nsame line\nother\n \n\n" * 4, "a b c d e f g h " * 30,
    ]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    repeated = [rows[6], rows[6]]
    return rows + repeated + [(None, prose(3), None, None, None), (None, None, None, None, None), (98, prose(4), "en", None, 5)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
