import pytest
from pyspark.sql import types as T

#: Names that operators use inside or return, as columns of a caller's table.
CLASHES = ["mark", "line", "number", "cls", "seq", "name", "n_words", "kept", "component_id", "held_out", "found", "__slot", "fit"]
LONG = " ".join(f"word{i % 977} tale{i % 31}" for i in range(15_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
PROSE = ("the quick brown foxes of the northern hills are running over frozen rivers while old farmers watch them from "
         "their wooden houses and tell each other long stories about winters that were colder and nights that were darker "
         "than anything which the younger people of the valley could ever imagine in their warm and quiet homes today")


def rows():
    other = PROSE.replace("farmers", "hunters")
    return [
        (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, other, "en", None), (4, None, "en", "b"), (5, "", None, "b"),
        (6, " \n\t ", "de", "a"), (7, LONG, "en", "a"), (8, "x " + PASSAGE + " y", "fr", "b"), (9, PASSAGE + " z " + PASSAGE, None, None),
        (10, "two words", "en", "a"), (11, "TWO WORDS", "en", "a"), (12, "line that repeats here\nline that repeats here\nLast one of them", "en", "b"),
        (13, "a b a b a b a b " * 20, "en", "a"), (14, "çà et là – déjà vu 日本語 text", "fr", "a"), (15, "12345 !!! 67", None, "c"),
        (16, "nul \0 inside and  double  spaces \n\n and\r\nreturns.", "en", "c"), (17, "<|endoftext|> as text", "en", "c"),
    ]


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
                      + [T.StructField(c, T.StringType()) for c in CLASHES])


def frame(spark, data, parts=3):
    full = [(d, t, la, s, None if t is None else len(t), *["clash"] * len(CLASHES)) for d, t, la, s in data]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


@pytest.fixture(scope="session")
def odd(spark):
    """Distinct ids: nulls, empty and long texts, copies and near copies, clashing extra columns."""
    return frame(spark, rows())


@pytest.fixture(scope="session")
def doubled(spark):
    """The same with every row twice, and a row without id."""
    return frame(spark, rows() * 2 + [(None, PROSE, "en", "a")])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
