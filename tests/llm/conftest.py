import random

import pytest

#: Columns that operators use inside, as further columns of the input.
CLASH = "size slot shard fp sha row n best range digests next sketch ids n_tokens score x taken draws target component_id kept_id key core planned_source c_id l_id quality y doc".split()


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "tion", "Haus", "été", "niño", "x1", "word", "löwe", "idiot", "rest", "stone"]) + rng.choice(["", "", ".", ",", "er"]) for _ in range(n))


def edge_rows() -> list[tuple]:
    """doc_id, text, lang, source, n_chars."""
    long = words(1, 9000)
    texts = [None, "", " \t\n ", "a", "one two", "one two three", long, long, long + " end", "日本語テキスト " * 30, "🙂" * 70, "x" * 5000, "<|endoftext|> mid <|endoftext|><|endoftext|>", "line\n" * 200, "it's we'll  I'd\r\n  end "]
    texts += [words(5, 60)] * 5 + [words(5, 60) + " more"] + [words(k, 40) for k in range(20, 40)]
    rows = [(k, t, "en", f"s{k % 3}" if k % 7 else None, None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[5], rows[16], (None, "no id", None, None, None), (None, words(5, 60), "de", "s1", 1), (3, "same id, other text", None, "s0", None)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, ids and texts, clashing columns."""
    schema = SCHEMA + "".join(f", `{c}` string" for c in CLASH)
    return spark.createDataFrame([(*r, *("extra" for _ in CLASH)) for r in edge_rows()], schema).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return edge_rows()
