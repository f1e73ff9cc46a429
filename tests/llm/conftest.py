import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from llm_support import LONG  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    return FOLDER


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, very long and repeated texts, null ids, clashing columns."""
    rows = [
        (1, None, "a"),
        (2, "", "b"),
        (3, " \n\t ", None),
        (4, LONG, "c"),
        (5, "one two three four five six", "d"),
        (5, "one two three four five six", "d"),
        (None, "one two three four five six", "e"),
        (6, "Ünïcode ½ ² \N{GRINNING FACE} 日本語 </s> [INST] <|endoftext|>", "f"),
        (7, "12 34 -- !!", "g"),
    ]
    names = "doc_id long, text string, tag string"
    docs = spark.createDataFrame(rows, names)
    # Names that results of the operators have.
    for c in ("score", "fp", "ids", "n_hit", "host", "label", "packed"):
        docs = docs.selectExpr("*", f"tag AS {c}")
    return docs
