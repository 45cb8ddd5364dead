import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or "")) for r in rows]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


ODD_TEXTS = [
    (1, "Some plain text of a few words, repeated. " * 8),
    (1, "Some plain text of a few words, repeated. " * 8),  # a row that is there twice
    (1, "The same id with another text."),
    (2, None),
    (3, ""),
    (4, " \t\r\n\x0b\x0c  "),
    (None, "No id, but a text with words."),
    (None, None),
    (5, "one"),
    (6, "日本語 русский é́ 🙂 ​ \x00 ??? 1234"),
    (7, "x" * 150_000),
    (8, "word " * 60_000),
    (9, "Some plain text of a few words, repeated. " * 8),
    (10, "0x1F; 12.5 %%% $$$ --- ___ {} [] <|endoftext|> <s> <0x0A>"),
]


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, ties and repeated rows, and columns with the names that
    the operators use themselves."""
    from pyspark.sql import functions as F

    clashing = (
        "score kept sequence_id ids id text_key redrawn lang_pred rejected n_entities anchor "
        "component_id shard key hash place row n_bytes spans label"
    ).split()
    frame = documents(ODD_TEXTS)
    return frame.select("*", *(F.lit(f"own {c}").alias(c) for c in clashing))


@pytest.fixture
def empty(documents):
    return documents([])
