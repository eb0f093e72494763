import random
import re

import pytest

SPACES = " \t\n\x0b\f\r"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with every oddity: nulls, empties, copies, ties, repeated ids, long and strange texts, clashing names."""
    random.seed(7)
    words = ["alpha", "Beta", "gamma", "déjà", "ÉTÉ", "x1", "the", "of", "license", "mit", "MIT", "cc", "by", "一二", "ß"]
    base = [" ".join(random.choices(words, k=random.randint(1, 60))) for _ in range(30)]
    lines = [" ".join(random.choices(words, k=6)) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [random.choice(base), *random.sample(lines, random.randint(0, 4)), "", "\t" + random.choice(lines).upper() + " "]
        random.shuffle(parts)
        rows.append((i, "\n".join(parts), random.choice(["en", "fr", None]), random.choice(["a", "b", None])))
    long_text = "\n".join(random.choices(base, k=400))
    rows += [
        (200, None, "en", "a"), (201, "", "fr", "a"), (202, " \t\n ", None, None), (203, long_text, "en", "b"),
        (204, long_text, "en", "b"), (205, "a" * 5000, "en", "b"), (206, "\n" * 50, "en", "b"),
        (207, "one\x0btwo\x0cthree\x1cfour\x85five six", "en", "b"),
        (208, "Released under the MIT License. mit license mit license", "en", "a"),
        (209, "gnu general\npublic license and CC-BY cc by", "en", "a"),
        (-5, base[0], "en", "a"), (None, base[0], "en", "a"), (None, None, None, None),
        (3, base[1], "en", "a"), (3, base[1], "en", "a"), (4, base[2] + " more", "en", None),
    ]
    made = [(*r, 1, 2, "k", True) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_lines int, pos int, key string, kept boolean"
    return spark.createDataFrame(made, schema).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
