"""Days between process milestones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.schema import STEP_LAGS, TOTAL_LAG


def milestone_lags(
    milestones: Sequence[Column], steps: Sequence[str] = STEP_LAGS, total: str = TOTAL_LAG
) -> dict[str, Column]:
    """Whole days between neighbouring milestones, and from the first to the last.

    A step that lacks either end is NULL, never zero. The total needs only the two ends.
    """
    lags = {
        name: F.datediff(end, begin)
        for name, begin, end in zip(steps, milestones, milestones[1:], strict=False)
    }
    lags[total] = F.datediff(milestones[-1], milestones[0])
    return lags
