import pytest

from samplewright.llm import components as C
from samplewright.llm.sparkio import Scratch


def test_rounds_that_run_out_raise(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    found = C.components(edges, Scratch(spark, "chain"), "chain").collect()
    assert len(found) == 41 and {r.label for r in found} == {0}
    monkeypatch.setattr(C, "ROUNDS", 2)
    with pytest.raises(RuntimeError):
        C.components(edges, Scratch(spark, "short"), "chain")
