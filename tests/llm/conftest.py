import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """Documents with nulls, blanks, ties, repeated rows, a long text and clashing column names."""
    line = "the old mill by the river turns a slow wheel of oak and iron every single day"
    long = " ".join(f"w{k * k % 9973}" for k in range(1_500))
    near = line.split()
    rows = [
        (1, line), (2, line), (2, line), (3, line.upper()), (None, line), (4, None), (5, ""),
        (6, " \t\n"), (7, long), (8, "x"), (9, line + " and night"), (10, line.replace(" ", "  ")),
        (11, None), (12, "a " * 40), (13, "mail bob@site.org or 1.2.3.4 or +1 (234) 555-0199"),
        (14, "4111 1111 1111 1111 and 4111 1111 1111 1112 @ a@b 999.1.1.1"),
        (15, "Released under the MIT License. CC BY-NC Apache License, Version 2.0"),
        (16, "é" * 50 + " " + line), (17, "<|endoftext|> x\0y  z\n\n"), (18, long + " tail"),
        (-5, "x"), (19, " ".join(near[::-1])), (20, line + "\x0b" + line), (None, None),
    ]
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        *(T.StructField(n, T.StringType()) for n in (
            "tag", "n", "kept", "words", "doc", "row", "score", "n_words", "_row", "h"))])
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame([(*r, *["z"] * 10) for r in rows], schema).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.filter("false")


@pytest.fixture(scope="session")
def docs(spark):
    """The smallest data folder's documents with every fifth row repeated under another id."""
    d = spark.read.parquet(f"{SMALL}/documents.parquet")
    return d.unionByName(d.filter("doc_id % 5 = 0").withColumn("doc_id", F.col("doc_id") + 100_000))


@pytest.fixture
def sql():
    """Run an operator's SQL over given tables."""
    def run(text: str, **tables):
        con = duckdb.connect()
        for name, df in tables.items():
            frame = df.select(*[F.col(c) for c in df.columns]).toArrow()
            con.register(name, frame)
        res = con.execute(text)
        return [d[0] for d in res.description], res.fetchall()
    return run


@pytest.fixture
def same(sql):
    """Assert that a result equals its SQL over the tables."""
    from tools.check import rows_of

    def check(df, text, **tables):
        names, rows = sql(text, **tables)
        got = rows_of(df.columns, df.collect())
        assert sorted(names) == sorted(df.columns)
        assert got == rows_of(names, rows)
    return check
