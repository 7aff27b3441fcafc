"""The check of a boosted model walks its rounds once."""

import io
from contextlib import redirect_stdout

from catalog import modelling


def test_errors_of_rounds_are_not_walked_again_by_the_result(spark, sf):
    with redirect_stdout(io.StringIO()) as plan:
        modelling.gbt_rounds(spark, sf).explain()
    assert "MapInArrow" not in plan.getvalue()
