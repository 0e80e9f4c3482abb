import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def table(spark):
    """A documents table from (id, text) or (id, text, lang, source) rows."""

    def make(rows, partitions=3):
        full = [(r + (None,) * 4)[:4] for r in rows]
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in full]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


@pytest.fixture
def clashing(table):
    """Documents with further columns named like the operators' own ones."""

    def make(rows):
        df = table(rows)
        for name in ("id", "body", "key", "kept", "rank", "owner", "cell", "place", "size", "found", "range", "hit"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture
def prose():
    """Texts of random words; passages, near and exact copies repeat among them."""

    def make(count, seed=1, words=120):
        rng = random.Random(seed)
        lexicon = ["".join(rng.choice("abcdefghiklmnoprstuvy") for _ in range(rng.randint(1, 8))) for _ in range(900)]
        text = lambda n: " ".join(rng.choice(lexicon) for _ in range(n))
        passage, texts = text(60), []
        for _ in range(count):
            kind = rng.random()
            if texts and kind < 0.15:
                texts.append(rng.choice(texts))
            elif texts and kind < 0.4:
                near = rng.choice(texts).split(" ")
                for _ in range(rng.randint(1, 3)):
                    near[rng.randrange(len(near))] = rng.choice(lexicon)
                texts.append(" ".join(near))
            elif kind < 0.55:
                texts.append(text(rng.randint(5, 40)) + "\n" + passage + " " + text(rng.randint(5, 40)))
            else:
                texts.append(text(rng.randint(1, words)))
        return texts

    return make


def odd_texts():
    """Nulls, empty, blank, very short, very long and repetitive texts."""
    return [
        None,
        "",
        " \n\t ",
        "x",
        "one two three four",
        "one two three four five",
        "a" * 5000,
        "ab " * 4000,
        "Größe überall, naïve café — 中文字符 🙂 " * 12,
        "é" * 150,
        "-" * 3000 + " end",
        "12345 67890 !!! ???",
    ]


@pytest.fixture
def oddities():
    return odd_texts()
