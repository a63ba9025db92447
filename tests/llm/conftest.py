import pytest

#: Texts that every operator must take: null, empty, blank, odd characters, long ones (the last longer than a piece of work), repeats.
ODD = [None, "", "   ", "\n\n\t", "é", "a", "½ — 𝒳   ", "word " * 4000, "x" * 3000, "long é " * 40000, "same text here\nand more of it", "same text here\nand more of it"]


@pytest.fixture
def odd(spark):
    """Odd texts with an id each but for one null id, a repeated row, and columns whose names could clash."""
    names = ["id", "key", "score", "lang", "fp", "label", "copies", "mark", "__id", "removed_lines", "lang_pred", "ambiguous", "line", "__lines", "start", "length", "offset", "size", "target", "rate", "taken", "class", "block", "spots", "fingerprint", "component", "paragraph", "family", "gone", "copy"]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t or "")) for i, t in enumerate(ODD)]
    rows += [rows[-1], (None, "a row without an id", "en", None, 19)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for n in names:
        if n not in df.columns:
            df = df.selectExpr("*", f"'x' as `{n}`")
    return df


@pytest.fixture
def empty(odd):
    return odd.limit(0)
