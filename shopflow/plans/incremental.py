"""Incremental integration: a delivery rewrites only the months of the wide sales table that it changes.

The wide table, partitioned by (anio, mes), is its own state: it holds each sale's
nine source columns, and picking the greatest row per sale is associative, so
dedupe(all deliveries) = dedupe(table and new delivery). Beside it lie the
dimensions of the last delivery. After any series of deliveries the table equals the
one that a full rebuild from all of them gives.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.operators import cleanse, integrate
from shopflow.plans.context import Retail
from shopflow.session import work_path
from shopflow.sources import tables

MONTH = ["anio", "mes"]
#: The dimensions, their key among the sales' columns, and the columns that the wide table takes from them.
DIMENSIONS = {
    "customers": ("cliente_id", ["cliente_id", *integrate.CUSTOMER_FIELDS]),
    "activity": ("cliente_id", ["cliente_id", *integrate.LOG_FIELDS]),
    "catalog": ("juego_id", ["juego_id", "plataforma", *integrate.CATALOG_FIELDS]),
    "scores": ("juego_id", ["juego_id", *integrate.SCORE_FIELDS]),
}


def dimensions(r: Retail) -> dict[str, DataFrame]:
    return {name: getattr(r, name).select(*cols) for name, (_, cols) in DIMENSIONS.items()}


def changed_keys(old: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """The keys that ``new`` holds with other rows than ``old``: added, gone or with another value. A key may have several rows."""
    keys = new.select(key)
    if old is not None:
        cols = new.columns
        sides = old.select(*cols, F.lit(-1).alias("_n")).unionByName(new.select(*cols, F.lit(1).alias("_n")))
        keys = sides.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n <> 0").select(key)
    return keys.filter(F.col(key).isNotNull()).distinct()


def _version(df: DataFrame) -> Column:
    """A sale's row in the order of ``cleanse.dedupe``, so that both agree on which of two rows stays."""
    return F.struct("fecha", *[c for c in cleanse.RAW_SALES_COLUMNS if c not in ("venta_id", "fecha")])


def changed_sales(old: DataFrame, new: DataFrame) -> DataFrame:
    """Sales of ``new`` that are not in ``old`` or beat its row: their source columns, whether they are added, and the date before (NULL if added).

    ``old`` is first cut to the sales of ``new``: where the delivery is under the broadcast bound, its rows are not shuffled."""
    left = new.withColumn("n", _version(new))
    right = old.select("venta_id", _version(old).alias("o")).join(new.select("venta_id"), "venta_id", "left_semi")
    met = left.join(right, "venta_id", "left")
    return met.filter(F.col("o").isNull() | (F.col("n") > F.col("o"))).select(
        *cleanse.RAW_SALES_COLUMNS, F.col("o").isNull().alias("added"), F.col("o.fecha").alias("before"))


def _month_number(year: Column, month: Column) -> Column:
    """One number per month; 0 stands for sales without a date."""
    return F.coalesce(year * 100 + month, F.lit(0))


def _in_months(months: list[int]) -> Column:
    return _month_number(F.col("anio"), F.col("mes")).isin(months)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back, for the steps that read it again."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class WideTable:
    """The wide sales table under ``root`` and the dimensions it was last joined with."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.path = f"{self.root}/ventas_enriquecidas"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _drop(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The whole table; ``schema`` where it may hold no file yet. Month columns are integers also if all are NULL."""
        reader = self.spark.read
        return (reader.schema(schema) if schema else reader).parquet(self.path).withColumns({c: F.col(c).cast("int") for c in MONTH})

    def _dimension(self, name: str) -> DataFrame | None:
        path = f"{self.root}/dimensiones/{name}"
        return self.spark.read.parquet(path) if self._exists(f"{path}/_SUCCESS") else None

    def touched_months(self, changed: DataFrame, now: Mapping[str, DataFrame], table: DataFrame) -> list[int]:
        """Months (yyyymm, 0: no date) whose rows change, by the changed sales and by changed
        dimension rows of any sale. The list is bounded by the calendar, not by the data."""
        both = changed.select(F.explode(F.array(F.struct(F.col("fecha").alias("d"), F.lit(True).alias("is")),
                                              F.struct(F.col("before").alias("d"), (~F.col("added")).alias("is")))).alias("m"))
        months = both.filter("m.is").select(_month_number(F.year("m.d"), F.month("m.d")).alias("m"))
        for key in ("cliente_id", "juego_id"):
            keys = None
            for name, (k, _) in DIMENSIONS.items():
                if k == key:
                    one = changed_keys(self._dimension(name), now[name], key)
                    keys = one if keys is None else keys.union(one)
            hit = table.join(keys.distinct(), key, "left_semi")
            months = months.union(hit.select(_month_number(F.col("anio"), F.col("mes")).alias("m")))
        return sorted(r.m for r in months.distinct().collect())

    def apply(self, raw_sales: DataFrame, now: Mapping[str, DataFrame]) -> list[int]:
        """Take a delivery of raw sales and the dimensions as they are ``now``; the months that were rewritten.

        A sale may move to another month, and a month may become empty: its folder goes.
        The months are worked out and written aside first, then put in place by dynamic
        partition overwrite, so files of other months stay as they are. Repeating a
        delivery changes nothing, and repeating one that stopped half-way completes it: every
        month's rows follow from the table and the delivery alone. A job that dies while
        Spark swaps a month's folder can lose that folder; ``rebuild`` is for that."""
        now = {name: kept(df, "dimension") for name, df in now.items()}
        new = kept(cleanse.clean_sales(raw_sales).select(*cleanse.RAW_SALES_COLUMNS), "delivery")
        schema = self._wide(new, now).schema
        if self._exists(self.path):
            table = self.read(schema)
            changed = kept(changed_sales(table, new), "changed")
        else:  # every sale of the delivery is new, and each has one row
            table = None
            changed = new.withColumns({"added": F.lit(True), "before": F.lit(None).cast("date")})
        months = self.touched_months(changed, now, self.spark.createDataFrame([], schema) if table is None else table)
        if months:
            # only sales that beat the table's row: a loser's better row may lie in a month that is not read
            won = changed.select(*cleanse.RAW_SALES_COLUMNS)
            self._rewrite(None if table is None else table.filter(_in_months(months)), won, now, months)
        for name, df in now.items():
            df.write.mode("overwrite").parquet(f"{self.root}/dimensiones/{name}")
        return months

    def _wide(self, sales: DataFrame, now: Mapping[str, DataFrame]) -> DataFrame:
        return integrate.wide_sales(sales, now["customers"], now["catalog"], now["scores"], now["activity"])

    def _rewrite(self, old: DataFrame | None, new: DataFrame, now: Mapping[str, DataFrame], months: list[int]) -> None:
        """The months anew from the table's rows in them (none: no table yet) and the sales that ``new`` brings, one row each."""
        sales = new
        if old is not None:
            sales = cleanse.dedupe(old.select(*cleanse.RAW_SALES_COLUMNS).unionByName(new), ["venta_id"], ["fecha"], latest=True)
        wide = self._wide(sales, now).filter(_in_months(months))
        staged = work_path(self.spark, "months")
        wide.hint("rebalance", *MONTH).write.partitionBy(*MONTH).parquet(staged)
        put = self.spark.read.schema(wide.schema).parquet(staged)
        put.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH).parquet(self.path)
        filled = {r.m for r in put.select(_month_number(F.col("anio"), F.col("mes")).alias("m")).distinct().collect()}
        for m in set(months) - filled:
            self._drop(f"{self.path}/{_folder(m)}")

    def rebuild(self, raw_sales: DataFrame, now: Mapping[str, DataFrame]) -> None:
        """The table from all raw sales at once."""
        sales = cleanse.clean_sales(raw_sales).select(*cleanse.RAW_SALES_COLUMNS)
        self._wide(sales, now).hint("rebalance", *MONTH).write.mode("overwrite").partitionBy(*MONTH).parquet(self.path)
        for name, df in now.items():
            df.write.mode("overwrite").parquet(f"{self.root}/dimensiones/{name}")


def _folder(month: int) -> str:
    year, m = (str(month // 100), str(month % 100)) if month else ("__HIVE_DEFAULT_PARTITION__",) * 2
    return f"anio={year}/mes={m}"


def run_deliveries(r: Retail) -> str:
    """The staged deliveries applied one by one; the root that holds the table and the months rewritten by each."""
    key = (*tables.session_key(r.spark), r.sf_dir, *sorted(tables.table(r.spark, r.sf_dir, "lineitem").inputFiles()))
    if key not in _RUNS:
        root = work_path(r.spark, "incremental")
        wide = WideTable(r.spark, root)
        now = {name: kept(df, "dimension") for name, df in dimensions(r).items()}
        for i, delivery in enumerate(tables.sale_deliveries(r.raw_sales)):
            at = {**now, "customers": tables.customers_at(now["customers"], i)}
            months = wide.apply(delivery, at)
            done = r.spark.createDataFrame([(i, m) for m in months], "entrega long, mes int")
            done.write.mode("append").parquet(f"{root}/meses")
        _RUNS[key] = root
    return _RUNS[key]


_RUNS: dict[tuple, str] = {}


def incremental_wide(r: Retail) -> DataFrame:
    """The wide table after all deliveries, equal to a full rebuild (tags as text)."""
    df = WideTable(r.spark, run_deliveries(r)).read()
    return df.withColumn("tags", F.array_join("tags", "|")).select(*cleanse.SALES_COLUMNS, *[c for c in df.columns if c not in cleanse.SALES_COLUMNS])


def incremental_months(r: Retail) -> DataFrame:
    """K1: the months that each delivery rewrote."""
    return r.spark.read.parquet(f"{run_deliveries(r)}/meses")


QUERIES = {f.__name__: f for f in (incremental_wide, incremental_months)}
