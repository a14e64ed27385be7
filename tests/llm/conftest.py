import pytest

TEXT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents with nulls, empties, repeats, ties, near copies, special strings, odd spaces and a long text."""
    line = "the quick brown fox jumps over the lazy dog near the river bank today and tomorrow"
    near = line.replace("lazy", "lasy")
    long = " ".join(f"word{i % 977} and Ünder{i % 31}" for i in range(30_000))
    rows = [
        (5, line, "en", "s0", None), (2, line, "en", "s1", 3), (9, near, None, None, 3), (9, near, None, None, 3), (1, "", "en", "s0", 0), (3, None, "en", "s0", 0), (None, line, "en", "s0", 1), (None, None, None, None, None),
        (11, "  \n\t ", "xx", "s0", 4), (12, "a", "en", "s0", 1), (13, "A  b\n\n c!. don't <|endoftext|> 12  x y \x00 z", "de", "s2", 1), (14, long, "en", "s0", len(long)), (15, "été où ça\n" + line + "\n" + near + "\nend", "fr", "s9", 9), (16, "😀 中文 ﬁ é", "zh", "s0", 2),
    ]
    return spark.createDataFrame(rows, TEXT_SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], TEXT_SCHEMA)
