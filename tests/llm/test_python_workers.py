"""A stage takes one Python worker a core: workers stay, with all they hold, for later stages."""

import pytest

from tests.conftest import SMALL
from tidemark.llm import components, ngram_join, paragraph_dedup


@pytest.mark.parametrize("find, label", [(ngram_join.near_duplicates, "join-groups-edges"), (paragraph_dedup.repeated_units, "paragraph-clusters-edges")])
def test_pairs_are_compared_and_merged_in_one_worker(spark, monkeypatch, find, label):
    plans = {}
    write = components.materialize

    def noted(frame, name):
        plans[name] = frame._jdf.queryExecution().optimizedPlan().toString()
        return write(frame, name)

    monkeypatch.setattr(components, "materialize", noted)
    find(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert plans[label].count("MapInArrow") == 1


def test_edges_made_of_rows(spark):
    # Of a row (a, b) the edges a - b and b - b: the latter joins nothing.
    def edges(batches):
        for batch in batches:
            a, b = batch.columns
            yield batch.from_arrays([a, b], ["u", "v"])
            yield batch.from_arrays([b, b], ["u", "v"])

    rows = spark.createDataFrame([(1, 2), (3, 2), (8, 9), (7, 7)], "a bigint, b bigint").repartition(3)
    got = components.connected_components(rows, "test", edges).collect()
    assert {(r.node, r.component, r.size) for r in got} == {(1, 1, 3), (2, 1, 3), (3, 1, 3), (8, 8, 2), (9, 8, 2)}
