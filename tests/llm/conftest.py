import pytest


@pytest.fixture
def frame(spark):
    """frame(rows, schema): a DataFrame from tuples."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def tables(spark, tmp_path):
    """tables(documents=frame, ...): a folder like the driver's, with these tables."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


ODD_TEXTS = [None, "", " ", "word", "Ünï çödé — 漢字", "a" * 70_000, "x y " * 40_000, "<|endoftext|> <|ENDOFTEXT|>", "tab\tand\x0bnew\nline\r\n"]


@pytest.fixture
def odd_documents(frame):
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD_TEXTS)] + [(3, "word", "en", "s"), (3, "word", "en", "s"), (None, "no id", None, None)]
    return frame(rows, "doc_id long, text string, lang string, start string")
