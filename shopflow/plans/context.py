"""Entities built once per (session, data folder) and shared by the queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.operators import cleanse, integrate, kpis, logs
from shopflow.schemas import CATALOG, CORRUPT, CUSTOMERS, INVENTORY_XML, REVIEWS, SALES
from shopflow.sources import files, tables


class Retail:
    """Lazily built raw and clean entities over one data folder.

    Every attribute is a lazy DataFrame: nothing runs until a query's
    result is consumed, and Catalyst prunes what a query does not need.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, salt: int = 0):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.salt = salt  # > 1: salt the dimension joins that many ways

    # raw, as the source files would deliver them
    @cached_property
    def raw_sales(self) -> DataFrame:
        return tables.raw_sales(self.spark, self.sf_dir)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return tables.raw_customers(self.spark, self.sf_dir)

    @cached_property
    def raw_catalog(self) -> DataFrame:
        return tables.raw_catalog(self.spark, self.sf_dir)

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return tables.raw_reviews(self.spark, self.sf_dir)

    @cached_property
    def log_lines(self) -> DataFrame:
        return tables.log_lines(self.spark, self.sf_dir)

    @cached_property
    def raw_inventory(self) -> DataFrame:
        return tables.raw_inventory(self.spark, self.sf_dir)

    @cached_property
    def sale_events(self) -> DataFrame:
        return tables.sale_events(self.spark, self.sf_dir)

    # clean
    @cached_property
    def sales(self) -> DataFrame:
        return cleanse.clean_sales(self.raw_sales)

    @cached_property
    def customers(self) -> DataFrame:
        return cleanse.clean_customers(self.raw_customers)

    @cached_property
    def catalog(self) -> DataFrame:
        return cleanse.catalog_exploded(self.raw_catalog)

    @cached_property
    def games(self) -> DataFrame:
        return cleanse.catalog_games(self.raw_catalog)

    @cached_property
    def scores(self) -> DataFrame:
        return integrate.review_scores(self.raw_reviews)

    @cached_property
    def activity(self) -> DataFrame:
        return logs.log_activity(self.log_lines)

    @cached_property
    def inventory(self) -> DataFrame:
        return cleanse.clean_inventory(self.raw_inventory)

    @cached_property
    def wide(self) -> DataFrame:
        return integrate.wide_sales(self.sales, self.customers, self.catalog,
                                    self.scores, self.activity, salt=self.salt)

    def items(self, *keys: str, scores: bool = False) -> DataFrame:
        """Sales summed by ``keys``, game and platform, with the catalogue's
        columns (and the review scores): what the game KPIs read."""
        sold = kpis.sold(self.sales, *keys, "juego_id", "plataforma")
        return integrate.enrich_sales(sold, catalog=self.catalog, scores=self.scores if scores else None)

    def people(self, *keys: str) -> DataFrame:
        """Sales summed by ``keys`` and customer, with the customer's columns."""
        return integrate.enrich_sales(kpis.sold(self.sales, *keys, "cliente_id"), customers=self.customers)


class WrittenSales:
    """The entities that KPIs and documents read, over the written wide sales
    table and inventory (the lineage cut of the batch job)."""

    def __init__(self, wide: DataFrame, inventory: DataFrame):
        self.sales = self.wide = wide
        self.inventory = inventory

    def items(self, *keys: str, scores: bool = False) -> DataFrame:
        """Every sale with its game's columns; nothing is joined, so nothing is summed before."""
        return kpis.each_sale(self.wide, *dict.fromkeys([*keys, *kpis.GAME_KEYS[: 5 if scores else 4]]))

    def people(self, *keys: str) -> DataFrame:
        return kpis.each_sale(self.wide, *dict.fromkeys([*keys, *kpis.CUSTOMER_KEYS]))


# Default raw file names of the shop's inputs.
RAW_FILES = {
    "sales": "ventas.csv",
    "customers": "clientes.csv",
    "catalog": "catalogo_juegos.json",
    "reviews": "resenas.json",
    "log": "logs_tienda.txt",
    "inventory": "inventario.xml",
}
INVENTORY_COLUMNS = {"juego_id": "_id", "titulo_inv": "titulo", "plataforma": "item._nombre",
                     "stock": "item.stock", "precio_inv": "item.precio",
                     "umbral": "item.umbral_reposicion"}


class RawFiles(Retail):
    """The same entities read from the shop's raw files (CSV, JSON, text,
    XML) with fixed schemas; everything downstream is shared with
    ``Retail``.  ``names`` overrides file names; a name may also be a folder
    or glob of many files, which is how the inputs scale out."""

    def __init__(self, spark: SparkSession, raw_dir: str, names: dict[str, str] | None = None,
                 json_lines: bool = False, salt: int = 0):
        super().__init__(spark, raw_dir, salt)
        self.names = {**RAW_FILES, **(names or {})}
        self.json_lines = json_lines

    def _path(self, what: str) -> str:
        return f"{self.sf_dir}/{self.names[what]}"

    @cached_property
    def raw_sales(self) -> DataFrame:
        return files.read_csv(self.spark, self._path("sales"), SALES).select(*SALES.fieldNames())

    @cached_property
    def raw_customers(self) -> DataFrame:
        return files.read_csv(self.spark, self._path("customers"), CUSTOMERS).select(*CUSTOMERS.fieldNames())

    @cached_property
    def raw_catalog(self) -> DataFrame:
        df = files.read_json(self.spark, self._path("catalog"), CATALOG, multiline=not self.json_lines)
        return df.select(*CATALOG.fieldNames())

    @cached_property
    def raw_reviews(self) -> DataFrame:
        df = files.read_json(self.spark, self._path("reviews"), REVIEWS, multiline=not self.json_lines)
        return df.select(*REVIEWS.fieldNames())

    @cached_property
    def log_lines(self) -> DataFrame:
        return files.read_lines(self.spark, self._path("log"))

    @cached_property
    def raw_inventory(self) -> DataFrame:
        return files.read_xml_nested(self.spark, self._path("inventory"), "juego", INVENTORY_XML,
                                     "plataformas.plataforma", INVENTORY_COLUMNS)

    @cached_property
    def rejected_rows(self) -> DataFrame:
        """Raw CSV / JSON / XML records that did not fit their schema: file,
        key (the first value of that name in the record) and the raw record
        (XML: the fields that parsed)."""
        out = None
        for what, schema, reader in (("sales", SALES, "csv"), ("customers", CUSTOMERS, "csv"),
                                     ("catalog", CATALOG, "json"), ("reviews", REVIEWS, "json")):
            if reader == "csv":
                df = files.read_csv(self.spark, self._path(what), schema)
            else:
                df = files.read_json(self.spark, self._path(what), schema, multiline=not self.json_lines)
            # The filter references every field, so the reader parses (and
            # checks) all of them instead of only a pruned subset, whatever
            # action runs on the result.
            key = schema.fieldNames()[0]
            fields = F.to_json(F.struct(*schema.fieldNames()))
            found = F.col(key) if reader == "csv" else F.regexp_extract(F.col(CORRUPT), f'"{key}":"([^"]*)"', 1)
            one = df.filter(F.col(CORRUPT).isNotNull() & fields.isNotNull()).select(
                F.lit(self.names[what]).alias("archivo"), found.alias("clave"), F.col(CORRUPT).alias("registro"))
            out = one if out is None else out.unionByName(one)
        xml = files.rejected_xml(self.spark, self._path("inventory"), "juego", INVENTORY_XML)
        return out.unionByName(xml.select(
            F.lit(self.names["inventory"]).alias("archivo"), F.col("_id").alias("clave"), F.to_json(F.struct(*xml.columns)).alias("registro")))
