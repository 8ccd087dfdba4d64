"""Column builders: pure JVM-side expressions, no Python per row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "SALES_PLATFORM_RULES", "CATALOG_PLATFORM_RULES", "PLATFORM_RULES",
    "MONTH_NAMES_ES", "PAYMENT_METHODS", "EVENT_TYPES",
    "LOG_SYSTEM_WORD", "RISK_THRESHOLD", "EVENT_DEFAULTS", "MONEY", "EXACT",
    "normalize_key", "canonicalize", "canonical_platform", "parse_date",
    "money", "exact", "money_sum", "money_avg", "exact_avg", "ratio", "pct_of", "line_total",
    "event_code", "money_label", "month_name",
]

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's for equal results.
# Platform rules, ordered, first substring match wins (on upper(trim(x))):
SALES_PLATFORM_RULES = [
    ("XBOX", "XBOX"),
    ("PS5", "PS5"),
    ("PS4", "PS4"),
    ("SWITCH", "SWITCH"),
    ("PC", "PC"),
]
CATALOG_PLATFORM_RULES = [
    ("XBOX", "XBOX"),
    ("PLAYSTATION 5", "PS5"),
    ("PLAYSTATION 4", "PS4"),
    ("NINTENDO", "SWITCH"),
    ("PC", "PC"),
]
# Payment methods seen in the recorded outputs.
PAYMENT_METHODS = ["Efectivo", "Yape", "Plin", "Tarjeta Crédito", "Tarjeta Débito"]
# Sale-event lifecycle types of the message stream.
EVENT_TYPES = ["venta_creada", "venta_confirmada", "pago_aprobado",
               "envio_preparado", "venta_completada", "venta_cancelada"]
# The word marking system lines of the activity log.
LOG_SYSTEM_WORD = "SISTEMA"
# Fraud alert threshold on riesgo_fraude (inclusive).
RISK_THRESHOLD = 0.75
# Defaults for events whose customer is unknown.
EVENT_DEFAULTS = {"cliente_nombre": "desconocido", "nivel_membresia": "Normal",
                  "distrito": "Desconocido"}
# Month names for the monthly report document (ours, Spanish as the report).
MONTH_NAMES_ES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
                  "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
# ---------------------------------------------------------------------------

# One rule list for both sides of the (juego_id, plataforma) join, so a sale
# and a catalogue entry spelled differently still agree.
PLATFORM_RULES = SALES_PLATFORM_RULES + CATALOG_PLATFORM_RULES

# Line totals are amounts of two decimals: they are summed and averaged exactly
# as such, then handed out as double.
MONEY = "decimal(18,2)"
# Prices, scores and risks keep six decimals through the arithmetic; only the
# product or the average is rounded.
EXACT = "decimal(24,6)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c, upper: bool = True) -> Column:
    """upper(trim(c)) -- applied to both sides of every join key."""
    c = F.trim(_c(c))
    return F.upper(c) if upper else c


def canonicalize(c, rules: Sequence[tuple[str, str]]) -> Column:
    """Ordered substring rules -> label; first match wins, else unchanged."""
    c = _c(c)
    out = None
    for needle, label in rules:
        cond = c.contains(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return c if out is None else out.otherwise(c)


def canonical_platform(c, rules: Sequence[tuple[str, str]] = PLATFORM_RULES) -> Column:
    return canonicalize(normalize_key(c), rules)


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Bad or missing dates become NULL (never an ANSI error)."""
    return F.try_to_date(_c(c), fmt)


def money(c) -> Column:
    """A two-decimal amount; NULL when it does not fit (NaN, too large)."""
    return _c(c).try_cast(MONEY)


def exact(c) -> Column:
    """A price, score or risk with its decimals; NULL when it does not fit."""
    return _c(c).try_cast(EXACT)


def money_sum(c) -> Column:
    """round(sum(x), 2) computed exactly on decimals, returned as double."""
    return F.round(F.sum(money(c)), 2).cast("double")


def money_avg(c) -> Column:
    """round(avg(x), 2) of two-decimal amounts, half-up, returned as double."""
    return F.round(F.avg(money(c)), 2).cast("double")


def exact_avg(c) -> Column:
    """round(avg(x), 2) of unrounded values, half-up, returned as double."""
    return F.round(F.avg(exact(c)), 2).cast("double")


def ratio(total, n, kind: str = "decimal(30,6)") -> Column:
    """round(total / n, 2), half-up, as double: an average from its parts."""
    return F.round(_c(total).cast(kind) / F.nullif(_c(n), F.lit(0)), 2).cast("double")


def pct_of(part, whole, digits: int = 1) -> Column:
    """round(part * 100 / whole, digits) on decimals, as double."""
    num = _c(part).cast("decimal(22,2)") * F.lit(100)
    return F.round(num / _c(whole).cast("decimal(22,2)"), digits).cast("double")


def line_total(price, qty) -> Column:
    """round(price * qty, 2) of the unrounded price, as double; NULL when the
    amount does not fit ``MONEY``."""
    return F.round(exact(price) * _c(qty), 2).try_cast(MONEY).cast("double")


def event_code(n, fmt: str = "EVT-%06d") -> Column:
    return F.format_string(fmt, _c(n))


def money_label(c, prefix: str = "S/") -> Column:
    """'S/1,234' -- whole units, half-up, thousands separators."""
    return F.concat(F.lit(prefix), F.format_number(F.round(money(c), 0), 0))


def month_name(month_col, names: Iterable[str] = MONTH_NAMES_ES) -> Column:
    arr = F.array(*[F.lit(n) for n in names])
    return F.try_element_at(arr, _c(month_col))
