"""Spot ladders."""

import numpy as np
import pytest

from volspark.operators import book


def test_spot_ladder(spark):
    ladder = book.spot_ladder(spark.createDataFrame([(100.0,)], "strike double"), -1, 1, 4).orderBy("step").collect()
    assert [r.x for r in ladder] == [-1.0, -0.5, 0.0, 0.5, 1.0]
    assert [r.scenario_spot for r in ladder] == pytest.approx([100 * np.exp(x) for x in (-1, -0.5, 0, 0.5, 1)])
