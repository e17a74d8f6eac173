"""Unit conversion expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEIGHT_COLS = ["weightKgPreparedItemComparisonUnit", "netWeightKgComparisonUnit",
               "grossWeightKgComparisonUnit"]


def unit_conversion(prepared="weightKgPreparedItemComparisonUnit",
                    net="netWeightKgComparisonUnit",
                    gross="grossWeightKgComparisonUnit", otherwise: float | None = 1.0) -> Column:
    """First of prepared, net, gross weight that is > 0, else ``otherwise``."""
    ws = [F.col(c).cast("double") for c in (prepared, net, gross)]
    return F.coalesce(*[F.when(w > 0, w) for w in ws], F.lit(otherwise).cast("double"))


def legacy_weight(prepared="weightKgPreparedItemComparisonUnit",
                  net="netWeightKgComparisonUnit",
                  gross="grossWeightKgComparisonUnit") -> Column:
    """Older generations test ``!= 0`` and have no 1.0 fallback."""
    ws = [F.col(c).cast("double") for c in (prepared, net, gross)]
    return F.coalesce(*[F.when(w != 0, w) for w in ws])


def to_kgl(quantity: Column, factor: Column) -> Column:
    """Quantity x factor, negatives (returns) floored at 0."""
    return F.greatest(quantity.cast("double") * factor, F.lit(0.0))


def kgl_to_units(kgl: Column, factor: Column, mode: str = "divide") -> Column:
    """kg/L back to sales units: 'divide' (current), 'round' or 'ceil' (older)."""
    safe = F.when(factor.isNull() | (factor == 0), F.lit(1.0)).otherwise(factor)
    q = F.try_divide(kgl, safe)
    if mode == "round":
        return F.round(q)
    if mode == "ceil":
        return F.ceil(q)
    return F.when(factor > 0, q).otherwise(F.lit(0.0))
