import pytest

SF_DIR = "/root/testdata/sf0.001"
#: Names that operators use inside; tables may bring columns of these names.
CLASHING = ["size", "target", "block", "keys", "label", "score", "key", "bucket", "rules", "copies", "lines", "near", "licence", "stats", "cell"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega").split()


def prose(seed: int, n: int) -> str:
    """``n`` words that hardly repeat a run."""
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, clashing=True):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(full, SCHEMA)
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}) if clashing else df

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    """NULLs in every column, empty and long texts, ties, repeated rows."""
    a = prose(1, 80)
    long = prose(2, 30_000)
    return [
        (1, a, "s1"), (2, a, "s1"), (2, a, "s1"), (3, a + " tail", None), (4, "", "s1"), (5, None, "s2"), (None, a, "s2"), (None, None, None),
        (6, "one", "s2"), (7, " \t\n ", "s2"), (8, long, "s1"), (9, "x " * 5000, "s3"), (10, "y" * 50_000, "s3"), (11, prose(3, 60) + "\n" + prose(4, 60), "s3"),
        (12, "café \U0001f600 ▁ \x00 \x85 \xa0 end", "s3"), (13, prose(3, 60), "s4"),
    ]


@pytest.fixture(scope="session")
def edges(docs_of, edge_rows):
    return docs_of(edge_rows)


@pytest.fixture(scope="session")
def no_rows(edges):
    return edges.filter("false")
