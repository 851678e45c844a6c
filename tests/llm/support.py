"""Awkward rows that every operator must take, and plain versions to compare with."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, digest string, "
    "kept boolean, score double, copy int, component string, suffix string, _hash string, first string"
)


def lower_ascii(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def words_of(text):
    return WORDS.findall(lower_ascii(text or ""))


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); the columns after n_chars clash with names used
    inside the operators."""
    full = [(*r, *["en", "src1"][len(r) - 2 :]) for r in rows]
    extra = (7, "x", True, 1.0, 3, "c", "s", "h", "f")
    return spark.createDataFrame(
        [(d, t, lang, s, None if t is None else len(t), *extra) for d, t, lang, s in full], SCHEMA
    )


def odd_rows():
    """Nulls in all columns, empty and white texts, a very long text, repeated rows, a shared id."""
    long_text = prose(1, 40_000)
    return [
        (1, None, None, None),
        (None, None, None, None),
        (2, "", "en", "src1"),
        (3, " \t\n", None, "src1"),
        (4, "one", "en", None),
        (5, long_text, "en", "src2"),
        (6, long_text, "en", "src2"),
        (7, prose(2, 60), "en", "src1"),
        (7, prose(2, 60), "en", "src1"),
        (8, prose(3, 60), "en", "src1"),
        (8, prose(4, 60), "de", "src1"),
        (None, prose(2, 60), "en", "src1"),
        (9, "éß \U0001f600 中文 \x00 mixed", "fr", "src1"),
        (10, "aaaa" * 30_000, "en", "src1"),
    ]


def odd_documents(spark):
    return documents(spark, odd_rows())


def no_documents(spark):
    return documents(spark, [])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
