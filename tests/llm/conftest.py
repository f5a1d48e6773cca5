import pytest

LONG = " ".join(f"long{i} word{i * 7 % 1000}" for i in range(40_000))
ODD = "Ünï códe text \U0001f600 <|endoftext|> tab\tline\r\nend\x0b\x0c it's I'll 12,345.6 ##a "

#: Null and repeated identifiers, null and empty texts, null sources, equal texts, repeated rows, a very long text.
EDGES = [
    (1, "A b c d", "en", "s2", 7),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (4, " \t\r\n ", "en", "s1", 5),
    (5, "a B c D", "de", "s1", 7),
    (5, "a B c D", "de", "s1", 7),
    (None, "a b c d", None, "s2", None),
    (None, None, None, None, None),
    (6, LONG, "en", "s1", len(LONG)),
    (7, ODD, "en", "ß", len(ODD)),
    (8, "one", "en", "s1", 3),
    (8, "two", "en", "s3", 3),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHES = ("size", "kept", "row", "file", "n", "digest", "score", "run", "queue", "part", "id", "ord", "keep_id", "mark", "shard", "target", "doc", "row_index")


@pytest.fixture(scope="session")
def clashing():
    """A frame with columns added whose names operators use themselves."""

    def of(df):
        from pyspark.sql import functions as F

        return df.withColumns({name: F.lit(f"own {name}") for name in CLASHES})

    return of


@pytest.fixture(scope="session")
def saved(spark, tmp_path_factory):
    """A frame as the operators get it: read from files."""

    def of(df):
        path = str(tmp_path_factory.mktemp("saved") / "table")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return of


@pytest.fixture(scope="session")
def edges(spark, saved, clashing):
    return saved(clashing(spark.createDataFrame(EDGES, COLUMNS)))


@pytest.fixture(scope="session")
def empty(spark, saved):
    return saved(spark.createDataFrame([], COLUMNS))


@pytest.fixture(scope="session")
def docs(spark, saved):
    def of(texts, source="s"):
        rows = [(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
        return saved(spark.createDataFrame(rows, COLUMNS))

    return of
