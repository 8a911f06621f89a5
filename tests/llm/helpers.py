"""Small tables with every awkward case, and plain definitions to test against."""

import random
import re

UP = {i: i + 32 for i in range(65, 91)}
#: Extra columns with names that operators use themselves.
DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, matches string, score double,"
    " gone string, k int, t int, spans string, id int, leaf int, row_key int, size int"
)
EXTRA = (7, "m", 0.5, "g", 1, 2, "s", 3, 4, 5, 6)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < 0.15 else "") for _ in range(n))


def awkward(spark, texts=()):
    """Documents with null ids, null, empty, very long and repeated texts, and clashing columns."""
    rng = random.Random(5)
    base = sentence(rng, 80)
    rows = [
        (1, base, "en", "a", 10),
        (2, base, "en", "a", 10),
        (2, base, "en", "a", 10),
        (3, None, "en", None, None),
        (4, "", None, "b", 0),
        (5, " \n\t ", "de", "b", 3),
        (None, sentence(rng, 60), None, "b", 1),
        (None, None, None, None, None),
        (6, sentence(rng, 20_000, 5000), "de", "c", 10**6),
        (7, "é" * 3000 + " 漢字 Привет", "fr", "c", 5),
        (8, "x", "en", "c", 1),
        (9, "— … 😀", "en", "c", 1),
    ]
    rows += [(100 + i, t, "en", "z", 5) for i, t in enumerate(texts)]
    return spark.createDataFrame([r + EXTRA for r in rows], DOCS)


def plain_docs(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def none(df):
    return df.filter("false")
