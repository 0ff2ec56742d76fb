import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def nothing_stays_cached(spark):
    """Frames that a module caches are given up with it; other tests look for what is left."""
    yield
    spark.catalog.clearCache()


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source) or (.., lang)."""
    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a",
                 len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)
    return make


def prose(seed: int, words: int, vocabulary: int = 5000) -> str:
    """Invented words in a fixed order."""
    state, out = seed * 7919 + 13, []
    for i in range(words):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(f"w{(state >> 33) % vocabulary}" + (".\n" if i % 17 == 16 else ""))
    return " ".join(out)
