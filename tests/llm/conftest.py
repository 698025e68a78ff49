import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho".split()


def prose(seed: int, n: int) -> str:
    """Deterministic words, few alike between seeds."""
    return " ".join(f"{WORDS[(seed * 7 + k * k + k) % len(WORDS)]}{(seed * 31 + k * 17) % 97}"
                    for k in range(n))


SHARED = prose(999, 60)
ODD_ROWS = [
    (1, prose(1, 80) + "\n" + SHARED), (2, prose(2, 30) + " " + SHARED + " " + prose(3, 30)),
    (3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "two words"), (8, prose(1, 80) + "\n" + SHARED),
    (9, prose(1, 80) + "\n" + SHARED), (9, prose(1, 80) + "\n" + SHARED), (None, prose(5, 40)),
    (None, None), (10, "word " * 400), (11, prose(11, 30_000)), (12, "Äpfel\x1cx y ́ 中文 <|endoftext|> 'll"),
    (-3, SHARED), (13, "a\x00b  c"), (14, "x" * 5000),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, long and repeated texts; further columns with names of operators."""
    df = spark.createDataFrame(ODD_ROWS, "doc_id long, text string").repartition(3)
    return df.select("*", F.lit(1).alias("score"), F.lit(2).alias("fp"), F.lit(3).alias("ids"),
                     F.lit(4).alias("__oid"), F.lit(5).alias("start"), F.lit(6).alias("__shard"),
                     F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"),
                     F.length("text").cast("long").alias("n_chars"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
