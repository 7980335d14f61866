import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The shared folder of the cluster; a test session names its own."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs."""

    def make(pairs, **more):
        rows = [(i, t) for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make


@pytest.fixture(scope="session")
def texts():
    """Whole texts of the small documents table by doc_id."""
    import pyarrow.parquet as pq

    table = pq.read_table(os.path.join(SF, "documents.parquet"), columns=["doc_id", "text"])
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n\x0b\f\r"), (4, "one"), (5, "one two"), (6, "one two three"), (7, "a" * 5000), (8, "b " * 3000),
    (9, "Ünïcode ß 漢字 🙂   x"), (10, "one two three"), (10, "one two three"), (None, "one  two three"), (11, "\x00 nul"),
]


@pytest.fixture
def awkward():
    return list(AWKWARD)
