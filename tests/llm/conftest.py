import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or longer rows; missing fields are null."""

    def build(rows, extra=()):
        full = [tuple(row) + (None,) * (5 - len(row)) for row in rows]
        table = spark.createDataFrame(full, DOCS)
        # Columns that operators make themselves, with other meanings.
        for name in extra:
            table = table.selectExpr("*", f"'clash' AS {name}")
        return table

    return build


LONG = "Wörter und words, " * 20000
ODD_ROWS = [
    (1, "The the cat sat."),
    (2, None),
    (3, ""),
    (None, "no id here"),
    (4, " \n\t "),
    (5, LONG),
    (1, "The the cat sat."),
    (6, "12 !? ..."),
    (7, "a  b\n  c   <|endoftext|> d "),
    (-8, "日本語 émigré ﬁ"),
]


@pytest.fixture
def odd_rows():
    return ODD_ROWS
