import pytest


@pytest.fixture(scope="session")
def tables(spark):
    """The smallest driver tables."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every awkward case, and a column whose name clashes with computed ones."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    long = " ".join(words[i * 7 % 20] + str(i % 97) for i in range(60_000))
    rows = [(1, None, 7), (2, "", 7), (3, " \n\t ", None), (4, long, 7), (5, " ".join(words), 7), (5, " ".join(words), 7), (6, " ".join(words).upper() + "!", 7), (None, "a b", 7), (7, "\x00 é\u3000日本 🙂 <|endoftext|>", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_words int")
