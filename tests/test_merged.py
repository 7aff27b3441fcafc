"""Partitions that learners start from."""

from types import SimpleNamespace

import pytest

from catalog.modelling import merged


@pytest.mark.parametrize("cores, wanted", [(4, 8), (12, 12)])
def test_learners_use_all_cores(cores, wanted):
    df = SimpleNamespace(coalesce=lambda n: n, sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=cores)))
    assert merged(df) == wanted
