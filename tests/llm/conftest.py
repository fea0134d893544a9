import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PASSAGE = ("Shared passage one goes here and runs on for a while.\nIt has a second line of about this length.\n"
           "And a third line, so that it is a chunk of lines.\nThe fourth line ends what the documents share.")
LONG = " ".join(f"word{i % 977}" for i in range(40_000))


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    return [
        (1, "One short text. Nothing in it repeats at all.", "en", "a", 10),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, PASSAGE, "en", "b", 5),
        (5, "Own first line.\n" + PASSAGE + "\nOwn last line.", "en", "b", 5),
        (5, "Own first line.\n" + PASSAGE + "\nOwn last line.", "en", "b", 5),
        (6, "same words " * 30, "fr", "c", 7),
        (7, "same words " * 30, "fr", "c", 7),
        (7, "the same id with another text, and some more words to fill it up", "de", "c", 7),
        (None, "a row without an id, and with some words in it", "en", None, 3),
        (None, PASSAGE, "en", None, 3),
        (8, LONG, "en", "d", 9),
        (9, " \t\n \x0b\f\r ", "en", "d", 9),
        (10, "日本語 の テキスト 🙂 é́ naïve ▁marked▁ text <|endoftext|> <s>", "ja", "e", 9),
        (11, "1234 5678 !!! ???", "en", "e", 9),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    """The rows above, with extra columns whose names the operators use inside."""
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    from pyspark.sql import functions as F
    return df.withColumns({"fp": F.lit("x"), "score": F.lit(1), "_h": F.lit(2), "rid": F.lit(3), "marks": F.lit("m"),
                           "words": F.lit("w"), "_k1": F.lit(0), "root": F.lit(1), "row": F.lit(4), "gid": F.lit(5)})


@pytest.fixture(scope="session")
def plain(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 1, 0), (5, 1, 1), (6, 0, 0), (None, 1, None), (11, None, 0)],
                                 "doc_id long, quality int, toxic int")
