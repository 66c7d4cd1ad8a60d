"""Components of long paths are closed, whatever the order of their ids."""

import random

import pytest

from raillark.llm import near_dedup


@pytest.mark.parametrize("path", [[0, *range(299, 0, -1)], random.Random(1).sample(range(1000), 1000)])
def test_long_chain(spark, path):
    edges = [*zip(path, path[1:], strict=False), (2000, 2001), (3000, 3000)]
    got = {r.node: r.label for r in near_dedup.components(spark.createDataFrame(edges, "hub long, member long")).collect()}
    assert got == dict.fromkeys(path, 0) | {2000: 2000, 2001: 2000, 3000: 3000}
