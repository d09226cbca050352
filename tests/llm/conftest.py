import pytest

#: Extra columns with names that the operators use inside.
EXTRA = ("node string, part int, score string, ids string, found int, words int, n_tokens int, "
         "hub string, matches string, toxicity string, `odd name` struct<a: int>")


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with clashing extra columns."""
    def make(rows):
        filled = [(i, t, "n", 1, "s", "i", 2, 3, 4, "h", "m", "t", (5,)) for i, t in rows]
        return spark.createDataFrame(filled, f"doc_id long, text string, {EXTRA}")

    return make
