from __future__ import annotations

import pytest

from marketloom.llm import graph


def test_unsettled_components_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint")
    with pytest.raises(RuntimeError, match="did not settle"):
        graph.components(edges, rounds=2)
    assert {r.component for r in graph.components(edges).collect()} == {0}
