import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quarrymill.llm.common import prepare  # noqa: E402


@pytest.fixture
def llm(spark):
    return prepare(spark)


@pytest.fixture
def texts(llm):
    """`texts((id, text), ...)` with further columns whose names the operators use themselves."""

    def make(*rows):
        more = [(i, t, k, None, "x") for k, (i, t) in enumerate(rows)]
        return llm.createDataFrame(more, "doc_id long, text string, row long, `a.b` string, words string")

    return make


LONG = " ".join(f"w{k % 977}" for k in range(60_000))


@pytest.fixture
def long_text():
    return LONG
