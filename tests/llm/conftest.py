import pytest
from pyspark.sql import DataFrame


@pytest.fixture
def hard(spark) -> DataFrame:
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns
    whose names the operators use themselves."""
    long = " ".join(f"word{i % 977} number{i}." for i in range(30_000))
    rows = [
        (1, "The first text of all, with some words in it. " * 4),
        (2, "The first text of all, with some words in it. " * 4),
        (2, "The first text of all, with some words in it. " * 4),
        (2, "Another text under the same id."),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (None, "A text without an id, which says little."),
        (None, None),
        (6, long),
        (7, "one"),
        (8, "Línea con ñandú, größe und été   😀 <|endoftext|>\nzweite  Zeile ."),
    ]
    clash = "fp long, text_hash string, n_tokens string, start string, spans int, edits string, node int, component string, shard int, hash int"
    return spark.createDataFrame(
        [(i, t.encode("utf-16", "surrogatepass").decode("utf-16") if t else t, None, None, 7, "a", "b", "c", 1, "d", 2, "e", 3, 4) for i, t in rows],
        "doc_id long, text string, lang string, source string, " + clash,
    )


@pytest.fixture
def nothing(spark) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def rows():
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
