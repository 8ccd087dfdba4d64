"""Q1-Q4: data-quality reports as Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """Q1: NULL count per column in a single aggregation pass, one row per
    column: (columna, nulos, filas)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (wide.unpivot(["__rows"], cols, "columna", "nulos")
                .select("columna", "nulos", F.col("__rows").alias("filas")))


def validate(df: DataFrame, rules: Sequence[tuple[str, Column]],
             reasons_col: str = "motivos") -> tuple[DataFrame, DataFrame]:
    """Q2: split into (valid, rejected); each rule is (reason, predicate that
    is TRUE when the row breaks it).  Rejected rows carry the list of
    reasons.  A NULL predicate counts as broken."""
    tagged = df.withColumn(reasons_col, _reasons(rules))
    return (tagged.filter(F.size(reasons_col) == 0).drop(reasons_col),
            tagged.filter(F.size(reasons_col) > 0))


def required(*cols: str) -> list[tuple[str, Column]]:
    return [(f"falta {c}", F.col(c).isNull()) for c in cols]


def game_rules() -> list[tuple[str, Column]]:
    """Document rules of the games collection on typed rows: its required fields."""
    return required("juego_id", "titulo", "categoria", "precio_base")


def value_rules() -> list[tuple[str, Column]]:
    """Value checks beyond the collection's rules; an absent value passes."""
    broken = {"precio_base no positivo": F.col("precio_base") <= 0,
              "pegi fuera de rango": ~F.col("pegi").isin(3, 7, 12, 16, 18)}
    return [(reason, F.coalesce(cond, F.lit(False))) for reason, cond in broken.items()]


def _reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(True)), F.lit(reason)) for reason, cond in rules]))


def validation_report(df: DataFrame, key: str, rules=None) -> DataFrame:
    """Q2 as one table: key, valido, motivos ('; '-joined)."""
    reasons = _reasons(rules if rules is not None else game_rules())
    return df.select(key, reasons.alias("__r")).select(
        key, (F.size("__r") == 0).alias("valido"), F.array_join("__r", "; ").alias("motivos"))


# Fixed contract of the games collection: required fields, and the type of each field that is there.
GAME_REQUIRED = ("juego_id", "titulo", "categoria", "precio_base")
GAME_TYPES = {"juego_id": "string", "titulo": "string", "categoria": "string", "plataformas": "array",
              "precio_base": "double", "pegi": "int"}
# Variant type names that count as each document type.
_TYPE_NAMES = {"string": "STRING", "array": "ARRAY", "double": "DOUBLE|DECIMAL", "int": "BIGINT"}


def document_report(docs: DataFrame, key: str = "juego_id", required_fields=GAME_REQUIRED, types=GAME_TYPES) -> DataFrame:
    """Q2 on JSON documents (column ``value``) as a document store checks
    them: required fields must be there, and a field that is there must have
    its type -- an explicit null has none.  Text that is no JSON object is
    one broken rule.  (key, valido, motivos)."""
    v = F.try_parse_json("value")
    field = {f: F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant")) for f in dict.fromkeys([*required_fields, *types])}
    rules = [("no es un documento", ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))]
    rules += [(f"falta {f}", field[f].isNull()) for f in required_fields]
    rules += [(f"tipo {f}", F.coalesce(~field[f].rlike(f"^({_TYPE_NAMES[t]})"), F.lit(False))) for f, t in types.items()]
    return docs.select(F.try_variant_get(v, f"$.{key}", "string").alias(key), _reasons(rules).alias("__r")).select(
        key, (F.size("__r") == 0).alias("valido"), F.array_join("__r", "; ").alias("motivos"))


def key_uniqueness(df: DataFrame, collection: str, key: str) -> DataFrame:
    """Q3 as one row: rows, distinct keys, and rows beyond the first of a key
    (rows without a key count as one key, as in a unique index)."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.sum("n").alias("filas"), F.count(F.lit(1)).alias("claves"), F.sum(F.col("n") - 1).alias("repetidas")).select(
        F.lit(collection).alias("coleccion"), F.lit(key).alias("clave"), "filas", "claves", "repetidas")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q3: keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("repeticiones"))
              .filter(F.col("repeticiones") > 1))


def orphan_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q4: key values of ``left`` with no match in ``right``, with the number
    of ``left`` rows carrying them.  ``left`` is reduced to distinct keys
    before the anti join, so only keys cross the shuffle."""
    counted = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas"))
    return counted.join(right.select(*keys).distinct(), list(keys), "left_anti")
