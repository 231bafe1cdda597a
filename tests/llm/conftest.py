from __future__ import annotations

import pytest

from eventtrails.session import local_session


@pytest.fixture(scope="session")
def spark():
    # never stopped here: the other tests' session is the same one
    return local_session(4, shuffle_partitions=4, app="eventtrails-tests")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame with columns whose names clash with the operators' own."""

    def make(rows):
        data = [(*r, *([None] * (3 - len(r))), "x", 1, True, "d", 7) for r in rows]
        return spark.createDataFrame(
            data, "doc_id long, text string, source string, digest string, row int, kept boolean, `h` string, `Size` long"
        )

    return make
