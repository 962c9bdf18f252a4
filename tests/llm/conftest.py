import pytest
from pyspark.sql import Row

LONG = "\n".join(" ".join(f"w{(7 * i + j * j) % 9973}" for j in range(60)) for i in range(900))
PROSE = " ".join(f"word{i}" for i in range(120))


def documents(spark, rows):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in any column, empty, blank and very long texts, ties, repeated rows, odd characters."""
    return [
        Row(None, None, None, None, None), Row(None, PROSE, "en", None, 3), Row(1, None, "en", "a", None), Row(2, "", "en", "a", 0),
        Row(3, " \t\n \x0b\x0c\r ", None, "a", 9), Row(4, LONG, "en", "b", len(LONG)), Row(5, LONG, "en", "b", len(LONG)),
        Row(6, PROSE, "en", "a", len(PROSE)), Row(6, PROSE, "en", "a", len(PROSE)), Row(6, PROSE + " more", "de", "a", None),
        Row(7, "İstanbul ΣΑΣ é naïve\x1cx <|endoftext|> it's 42!", "tr", "c", 1), Row(8, "x" * 5000, "en", "c", 5000),
        Row(9, "\n" * 50, "en", "c", 50), Row(10, "ab " * 2000, "en", "c", 6000),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return documents(spark, odd_rows)


@pytest.fixture(scope="session")
def crowded(odd):
    """The odd rows with further columns whose names operators use inside or return."""
    from pyspark.sql import functions as F

    names = (
        "fp a b at gone doc uid n count kept n_lines n_dropped n_words host spans start end path unit license kind cosine up own "
        "component_id fingerprint item_id piece length ids sequence_id offset held_out score n_bytes words tokens"
    ).split()
    return odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
