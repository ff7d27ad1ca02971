from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import ROWS  # noqa: E402

CLASHING = "id n label digest share unit kept score length rank task place lot norm own_text fold statistics spans"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents of the given rows, with other columns whose names an operator may use itself."""

    def make(rows):
        clashing = CLASHING.split()
        kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clashing)
        full = [(i, t, None, "s", len(t or ""), *[f"{c}!" for c in clashing]) for i, t in rows]
        return spark.createDataFrame(full, kind).repartition(3)

    return make


@pytest.fixture(scope="session")
def edges(frame):
    return frame(ROWS)


@pytest.fixture(scope="session")
def nothing(frame):
    return frame([])
