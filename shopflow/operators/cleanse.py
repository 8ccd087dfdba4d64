"""Cleansing, key normalisation, dedupe, explode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.columns import (
    PLATFORM_RULES, canonicalize, line_total, normalize_key, parse_date,
)
from shopflow.functions.predicates import positive_price

SALES_COLUMNS = ["venta_id", "fecha", "cliente_id", "juego_id", "plataforma", "precio",
                 "cantidad", "metodo_pago", "vendedor", "mes", "anio", "trimestre", "total"]
RAW_SALES_COLUMNS = SALES_COLUMNS[:9]
CATALOG_COLUMNS = ["juego_id", "titulo", "categoria", "plataforma", "precio_base",
                   "desarrollador", "anio_lanzamiento", "pegi", "tags"]


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
           latest: bool = True) -> DataFrame:
    """One row per key, chosen by a total order.

    The kept row is the greatest (``latest``) or least row by
    (``order_by`` columns, then every other column), NULL lowest -- so the
    choice never depends on partitioning.  Written as an aggregate
    (max/min over a struct) rather than a window: map-side partial
    aggregation collapses duplicates before the shuffle, so a key holding a
    large share of the rows never lands whole in one task.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*order_by, *rest)
    pick = F.max(packed) if latest else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("__row"))
    return out.select(*[F.col(c) if c in keys else F.col("__row").getField(c).alias(c)
                        for c in df.columns])


def add_date_parts(df: DataFrame, date_col: str = "fecha", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Parse the date (bad -> NULL), add mes, anio, trimestre."""
    if dict(df.dtypes)[date_col] == "string":
        df = df.withColumn(date_col, parse_date(F.col(date_col), fmt))
    return df.withColumns({
        "mes": F.month(date_col), "anio": F.year(date_col), "trimestre": F.quarter(date_col)})


def add_total(df: DataFrame, price: str = "precio", qty: str = "cantidad",
              out: str = "total") -> DataFrame:
    """Line total = round(price * qty, 2)."""
    return df.withColumn(out, line_total(price, qty))


def add_flag(df: DataFrame, col: str, threshold: float, out: str) -> DataFrame:
    """Boolean flag col >= threshold."""
    return df.withColumn(out, F.col(col) >= F.lit(threshold))


def explode_array(df: DataFrame, array_col: str, out: str, outer: bool = False) -> DataFrame:
    """One row per array element (``outer`` keeps NULL / empty arrays)."""
    fn = F.explode_outer if outer else F.explode
    return df.withColumn(out, fn(F.col(array_col)))


def _normalized_sales(raw: DataFrame, rules) -> DataFrame:
    return raw.withColumns({
        "fecha": parse_date("fecha"),
        "venta_id": F.trim(F.col("venta_id")),
        "cliente_id": normalize_key("cliente_id"),
        "juego_id": normalize_key("juego_id"),
        "plataforma": canonicalize(normalize_key("plataforma"), rules),
    }).select(*RAW_SALES_COLUMNS)


def sale_problem() -> Column:
    """Why a sale cannot be counted, or NULL: no id to tell it from others, or
    a price that is no number or whose line total does not fit an amount."""
    unfit = F.isnan("precio") | (positive_price() & F.col("cantidad").isNotNull() & line_total("precio", "cantidad").isNull())
    return (F.when(F.col("venta_id").isNull(), F.lit("venta_id nulo"))
            .when(F.coalesce(unfit, F.lit(False)), F.lit("precio fuera de rango")))


def clean_sales(raw: DataFrame, rules=PLATFORM_RULES) -> DataFrame:
    """P1-P8 on sales: dates, keys, canonical platform, price > 0, one row per
    venta_id; date parts and totals are derived from the rows that are left,
    so the dedupe shuffles the nine source columns only.  Sales with a
    ``sale_problem`` go to ``rejected_sales``."""
    return latest_sales(countable_sales(raw, rules))


def countable_sales(raw: DataFrame, rules=PLATFORM_RULES) -> DataFrame:
    """The first half of ``clean_sales``: every row that counts, a sale's repeated ones too."""
    return _normalized_sales(raw, rules).filter(sale_problem().isNull() & positive_price("precio"))


def latest_sales(rows: DataFrame) -> DataFrame:
    """The second half: one row per venta_id, with date parts and total."""
    df = dedupe(rows, ["venta_id"], ["fecha"], latest=True)
    return add_total(add_date_parts(df, "fecha")).select(*SALES_COLUMNS)


def rejected_sales(raw: DataFrame, rules=PLATFORM_RULES) -> DataFrame:
    """The sales that ``clean_sales`` cannot count, each row with its reason."""
    return _normalized_sales(raw, rules).withColumn("motivo", sale_problem()).filter(F.col("motivo").isNotNull())


def clean_customers(raw: DataFrame) -> DataFrame:
    """P5/P8 on customers: trimmed text, one row per cliente_id."""
    df = raw.withColumns({
        "cliente_id": normalize_key("cliente_id"),
        "nivel_membresia": F.trim(F.col("nivel_membresia")),
        "distrito": F.trim(F.col("distrito")),
    }).select("cliente_id", "nombre", "edad", "genero", "distrito", "nivel_membresia")
    return dedupe(df, ["cliente_id"], latest=True)


def catalog_exploded(raw: DataFrame, rules=PLATFORM_RULES, outer: bool = False) -> DataFrame:
    """P9/P10/P6 on the catalogue: one row per (juego_id, canonical platform).

    Two spellings that collapse into one label would duplicate sales in the
    composite join, so the pairs are deduplicated after canonicalisation.
    """
    df = explode_array(raw, "plataformas", "plataforma", outer)
    df = df.withColumns({
        "juego_id": normalize_key("juego_id"),
        "plataforma": canonicalize(normalize_key("plataforma"), rules),
    }).select(*CATALOG_COLUMNS)
    return dedupe(df, ["juego_id", "plataforma"], latest=True)


def catalog_games(raw: DataFrame) -> DataFrame:
    """The catalogue with normalised ids, one document per juego_id."""
    df = raw.withColumn("juego_id", normalize_key("juego_id"))
    return dedupe(df, ["juego_id"], latest=True)


def clean_inventory(raw: DataFrame, rules=PLATFORM_RULES) -> DataFrame:
    """P4/P6 on inventory rows -- both sides of every join agree."""
    return raw.withColumns({
        "juego_id": normalize_key("juego_id"),
        "plataforma": canonicalize(normalize_key("plataforma"), rules),
    })
