import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: extra columns whose names the operators use themselves
CLASHING = ("document", "found", "parts", "removed", "first", "mask", "start", "score", "rule", "host", "verdict",
            "anchor", "digest", "text_key", "fingerprint", "component_id", "n_words", "n_hit", "items", "spans",
            "n_removed", "kept_text", "rebuilt", "held_out", "tokens", "budget", "rest", "epoch", "domain", "kept_id",
            "rows", "h1", "line", "near", "low", "dim", "n")

#: ties, repeated rows, nulls in every column, empty, blank and long texts
LONG = " ".join(f"word{i % 997}" for i in range(30_000))
COPIED = " ".join(f"copied{i}" for i in range(120)) + ".\nAnd one line that everybody has copied."


def edge_rows():
    return [
        (1, None, "en", "src0", 0), (2, "", "en", "src1", 0), (3, " \n\t ", "de", "src2", 4), (4, LONG, "en", "src0", len(LONG)),
        (5, COPIED, "en", "src0", len(COPIED)), (5, COPIED, "en", "src0", len(COPIED)), (6, COPIED, "fr", "src1", len(COPIED)),
        (None, COPIED, "en", "src0", len(COPIED)), (7, COPIED + " more", None, None, None), (8, "12 34", "es", "other", 5),
        (9, "naïve café déjà vu", "fr", "src5", 18), (10, "a" * 5_000, "de", "src2", 5_000), (11, "x", "en", "src3", 1)]


@pytest.fixture()
def edge_docs(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(edge_rows(), DOCUMENTS)
    return docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
