import pytest
from llm_fixtures import prose

#: Names that operators use inside or return; the values are of no matter.
CLASHING = ["__text", "__score", "__gone", "__items", "__longest", "__n", "__key", "__ids", "__node", "__row_key", "__size", "piece_ids", "n_pieces", "node", "hash"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score string, group_size int, " + ", ".join(f"`{c}` string" for c in CLASHING)


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls in every column, empty and blank texts, a long text, ties, repeated rows, and columns with clashing names."""
    long = prose(1, 6000)
    texts = {
        1: prose(2, 60), 2: prose(2, 60), 3: prose(3, 80), 4: "", 5: None, 6: "   \n\t ", 7: long, 8: long + " end", 9: "one two", 10: "one two", 11: "▁ café 你好 \U0001f600\x00!",
        12: prose(3, 80).upper(), 13: "???", 14: "123 456", 15: prose(4, 3),
    }
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", i, True, "x", 7) for i, t in texts.items()]
    rows += [rows[0], rows[0], (None, prose(2, 60), None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (3, prose(5, 40), "de", "s", 0, False, "y", 1)]
    return [(*r, *([f"own {r[0]}"] * len(CLASHING))) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
