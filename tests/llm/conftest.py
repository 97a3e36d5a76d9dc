import random

import pytest

SF = "/root/testdata/sf0.001"
WORDS = ["the", "Of", "zz", "éa", "x9", "stone", "river", "blue", "under", "quiet", "machine", "paper"]


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): null and repeated ids, null, empty and very long texts, ties,
    repeated rows, exact and near copies, shared passages."""
    rnd = random.Random(11)
    text = lambda n: " ".join(rnd.choice(WORDS) + rnd.choice(["", "", ",", ".\n"]) for _ in range(n))
    passage, base = text(70), text(120)
    rows = [(None, None), (None, base), (1, None), (2, ""), (3, "a"), (3, "a"), (4, "a" * 400), (5, base), (6, base),
            (7, base + " more"), (8, text(20) + " " + passage + " " + text(15)), (9, passage), (9, text(40)),
            (10, text(30) + "\n" + passage), (11, "é日😀" * 60), (12, "日😀é" * 60), (13, text(9000)), (14, "  \n\t "),
            (15, "!!! ??? ..."), (2**40, text(60)), (-7, text(60))]
    return rows + [(100 + i, text(rnd.randint(0, 80))) for i in range(25)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def by_text(rows):
    return sorted(rows, key=str)
