import random

import pytest

#: Columns that the operators use inside themselves.
CLASHING = ("oid", "text_hash", "fp", "digest", "keep_id", "size", "u", "seed", "start", "pattern", "node", "at", "n", "rules", "ids", "decoded")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


@pytest.fixture(scope="session")
def table(spark):
    def make(rows):
        """A documents table of (doc_id, text) or (doc_id, text, source) rows, with clashing extra columns."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *("x" for _ in CLASHING)) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Rows with missing, empty, blank, long, equal and repeated texts, a missing and a repeated id."""
    rng = random.Random(4)
    word = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    text = [" ".join(rng.choice(word) for _ in range(n)) for n in (3, 60, 120, 130, 51, 50, 49, 200)]
    long = " ".join(rng.choice(word) for _ in range(9000))
    rows = [(i, t) for i, t in enumerate(text)]
    rows += [(20, None), (21, ""), (22, " \t\n"), (23, text[2]), (24, text[2].replace(" ", " \n")), (25, long), (26, "x" * 30000)]
    rows += [(27, text[3] + " " + text[1]), (28, text[1][:150] + " " + text[7]), (29, text[2].upper()), (19, text[7])]
    return rows + [(None, text[2]), (None, None), (23, text[2]), (3, text[4]), (30, "漢字 £5 " * 40), (31, "漢字 £5 " * 40 + "end")]
