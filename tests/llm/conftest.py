import pytest

from landfall.llm.common import ship_package

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id long, key string, norm string, chunk int, size long, th long, fp long, slot int, label int, k int, sha string")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows as (doc_id, text, source) into a table whose other columns clash with working names."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None, 7, "x", None, 1, 2, 3, 4, 5, 6, 7, "y") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)
    return make
