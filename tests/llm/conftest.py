import pytest
from pyspark.sql import functions as F

WORDS = ("the river of stone and light runs over hills to an old harbour where ships wait for wind while "
         "children count birds on long grey walls before evening rain falls softly again").split()


def sentence(seed: int, length: int) -> str:
    state, out = seed * 2654435761 % 2**32 + 1, []
    for _ in range(length):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[(state >> 8) % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="session")
def documents(spark):
    """``documents`` with the columns of the given tables, from (doc_id, text[, source[, lang]]) rows."""
    def build(rows, extra=False):
        filled = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "src0",
                   None if r[1] is None else len(r[1])) for r in rows]
        frame = spark.createDataFrame(filled, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:  # names the operators use themselves
            for name in ("fingerprint", "component_id", "score", "predicted", "list", "u", "v", "id", "tokens",
                         "bucket", "batch", "n_tokens", "host", "path", "evidence"):
                frame = frame.withColumn(name, F.lit("clash"))
        return frame
    return build
