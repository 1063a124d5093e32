import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use for themselves.
CLASHING = ["doc", "text_lang", "size", "key", "target", "times", "part", "base", "terms", "node",
            "component", "digest", "kept", "own_id", "h", "grams", "told"]


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text[, source[, lang]]), with clashing columns if asked for."""
    def make(rows, clashing=False):
        full = []
        for row in rows:
            doc_id, text, source, lang = (*row, *(None,) * (4 - len(row)))
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, SCHEMA)
        if clashing:
            df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHING], "1 AS `odd.na``me`")
        return df

    return make


def words(n, seed=0):
    """n words of an invented vocabulary."""
    import random

    rng = random.Random(seed)
    syllables = ["ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu"]
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
