"""Rounding to two decimals without a per-row BigDecimal.

``F.round`` on a double formats the value as text and rounds the text half up.
That is the wanted result, but it costs about as much as the rest of a scan.
Away from a tie the nearest hundredth is unambiguous, so ``rint`` finds the
very same double; only values next to a tie, huge ones and NaN take the slow
branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below 1e9 hundredths a double resolves 1.2e-7, well inside the tie margin.
_TIE_MARGIN = 1e-6
_EXACT_BELOW = 1e9


def round_half_up(value: Column) -> Column:
    """Same result as ``F.round(value, 2)`` for any double."""
    hundredths = value * F.lit(100.0)
    nearest = F.rint(hundredths)
    off_tie = F.abs(F.abs(hundredths - nearest) - F.lit(0.5)) > F.lit(_TIE_MARGIN)
    in_range = F.abs(hundredths) < F.lit(_EXACT_BELOW)
    # Adding zero turns -0.0 into 0.0, as rounding through text does.
    fast = nearest / F.lit(100.0) + F.lit(0.0)
    return F.when(off_tie & in_range, fast).otherwise(F.round(value, 2))
