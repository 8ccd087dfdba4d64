"""Named filter predicates (Column builders)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopflow.functions.columns import RISK_THRESHOLD

__all__ = ["positive_price", "present", "low_stock", "risky", "flag_at"]


def positive_price(c: str = "precio") -> Column:
    """Keep price > 0 (a NULL or NaN price is dropped as well)."""
    return F.coalesce((F.col(c) > 0) & ~F.isnan(c), F.lit(False))


def present(*cols: str) -> Column:
    """all named columns are not NULL."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def low_stock(stock: str = "stock", threshold: str = "umbral") -> Column:
    """stock at or below the reorder threshold (inclusive)."""
    return F.col(stock) <= F.col(threshold)


def flag_at(c: str = "riesgo_fraude", threshold: float = RISK_THRESHOLD) -> Column:
    """Derived risk flag = risk >= threshold."""
    return F.col(c) >= F.lit(threshold)


def risky(flag: str = "venta_riesgosa", risk: str = "riesgo_fraude",
          threshold: float = RISK_THRESHOLD) -> Column:
    """flag is true OR risk >= threshold (three-valued OR; NULL -> no row)."""
    return F.coalesce((F.col(flag) == F.lit(True)) | flag_at(risk, threshold), F.lit(False))
