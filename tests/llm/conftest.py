import pytest


@pytest.fixture(scope="session", autouse=True)
def workers_see_the_package(spark):
    import __spark_entry__ as E

    E._show_package_to_workers(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents-like frame from (doc_id, text) pairs, with columns whose names operators use inside."""
    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, owner string, score string, kept string, h1 string"
        data = [(i, t, "en", "s", None if t is None else len(t), 7, "x", "y", "z", "w") for i, t in rows]
        return spark.createDataFrame(data, schema)
    return make
