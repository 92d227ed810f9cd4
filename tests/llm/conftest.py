import random

import pytest

DOCS = "doc_id long, text string, d string, s double, spans int, rank string, items int, row long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with extra columns whose names operators use inside; ids may be None or repeat."""
    from cellroll.llm.tables import importable

    importable(spark)

    def make(rows):
        return spark.createDataFrame([(i, t, "x", 0.5, 1, "r", 2, 3) for i, t in rows], DOCS).repartition(3)

    return make


@pytest.fixture()
def vocabulary():
    r = random.Random(5)
    return ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(300)]

