"""Review scores and the wide sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.columns import exact_avg, normalize_key
from shopflow.operators import cleanse

# Fixed output contract: the columns each dimension adds to the wide sales table.
CUSTOMER_FIELDS = ["nombre", "edad", "genero", "distrito", "nivel_membresia"]
CATALOG_FIELDS = ["titulo", "categoria", "desarrollador", "anio_lanzamiento", "tags"]
SCORE_FIELDS = ["puntuacion_promedio", "total_resenas", "total_votos_util"]
LOG_FIELDS = ["compras_en_log", "sesiones_log"]


def salted_left_join(left: DataFrame, right: DataFrame, key: str, buckets: int,
                     salt_from: list[str]) -> DataFrame:
    """Left join that spreads a hot ``key`` over ``buckets`` tasks.

    Each left row gets a salt from a hash of its own (unique) columns
    ``salt_from``; the right side -- unique per key -- is replicated once per
    salt value.  Every left row meets exactly the one replica with its salt,
    so the result equals the plain left join, while a key holding a third
    of the left rows is split ``buckets`` ways.  The replication is bounded
    by ``buckets`` (no pairs within a group are formed).  An alternative to
    AQE's skew join when that is off or when the hot key sits on a side it
    cannot split."""
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*salt_from), F.lit(buckets)))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                              F.lit(buckets - 1).cast("long"))))
    return salted.join(copies, [key, "__salt"], "left").drop("__salt")


def review_scores(reviews: DataFrame) -> DataFrame:
    """A1: per game round(avg score, 2), count of review ids, sum of votes."""
    return (reviews.withColumn("juego_id", normalize_key("juego_id"))
                   .groupBy("juego_id")
                   .agg(exact_avg("puntuacion").alias("puntuacion_promedio"),
                        F.count("resena_id").alias("total_resenas"),
                        F.sum("util_votos").alias("total_votos_util")))


def game_dimension(catalog: DataFrame | None, scores: DataFrame | None) -> DataFrame:
    """One row per juego_id: its platforms as a map platform -> catalogue
    fields, plus the review scores (either may be left out).

    The catalogue is keyed by (juego_id, plataforma) and the scores by
    juego_id; folding both into a single juego_id-keyed dimension lets the
    sales meet them in one join (one shuffle of the sales when the
    dimension is too big to broadcast).  A game's map holds one entry per
    canonical platform of that game -- no more than the game's own
    ``plataformas`` array in the source record -- so the per-game list is
    bounded by the input record, not by the data volume.  The full
    outer join keeps scores of games missing from the catalogue, exactly
    as two separate left joins would.
    """
    if catalog is None:
        return scores.select("juego_id", *SCORE_FIELDS)
    entries = F.map_from_entries(F.collect_list(F.struct(
        F.col("plataforma"), F.struct(*CATALOG_FIELDS)))).alias("__plat")
    games = (catalog.filter(F.col("plataforma").isNotNull())
                    .groupBy("juego_id").agg(entries))
    if scores is None:
        return games
    return games.join(scores.select("juego_id", *SCORE_FIELDS), "juego_id", "full_outer")


def enrich_sales(sales: DataFrame, customers: DataFrame | None = None, catalog: DataFrame | None = None,
                 scores: DataFrame | None = None, activity: DataFrame | None = None,
                 salt: int = 0) -> DataFrame:
    """Sales left-joined to customers, catalogue (juego_id, plataforma),
    review scores and log activity.  Every dimension is unique on its key
    (deduped / aggregated), so the sale count is preserved.

    A dimension that is not given is not joined: Catalyst cannot drop such a
    join by itself, as it does not know that the key is unique.  ``sales`` may
    also be sales aggregated by (at least) the keys of the given dimensions;
    then a hot key reaches the join as one row.

    Dimensions sharing a key are combined first -- customers with log
    activity on cliente_id, catalogue with review scores on juego_id (see
    ``game_dimension``) -- so the (large) sales side takes two joins, not
    four.  Join strategy is left to Spark: a dimension under the broadcast
    threshold is broadcast (checked on plan statistics, and again at
    runtime by AQE on the real shuffle size), a larger one becomes a
    sort-merge join where AQE splits skewed sale partitions.
    ``salt=N`` salts both joins N ways (``salted_left_join``) for hot keys.
    """
    def left_join(df, dim, key):
        if salt > 1:
            return salted_left_join(df, dim, key, salt, ["venta_id"])
        return df.join(dim, key, "left")

    wide, cols = sales, list(sales.columns)
    people = customers.select("cliente_id", *CUSTOMER_FIELDS) if customers is not None else None
    if activity is not None:
        act = activity.select("cliente_id", *LOG_FIELDS)
        people = act if people is None else people.join(act, "cliente_id", "full_outer")
    if people is not None:
        wide = left_join(wide, people, "cliente_id")
    if customers is not None:
        cols += CUSTOMER_FIELDS
    if catalog is not None or scores is not None:
        wide = left_join(wide, game_dimension(catalog, scores), "juego_id")
    if catalog is not None:
        entry = F.try_element_at(F.col("__plat"), F.col("plataforma"))
        cols += [entry.getField(c).alias(c) for c in CATALOG_FIELDS]
    if scores is not None:
        cols += SCORE_FIELDS
    if activity is not None:
        cols += LOG_FIELDS
    return wide.select(*cols)


def wide_sales(sales: DataFrame, customers: DataFrame, catalog: DataFrame, scores: DataFrame, activity: DataFrame,
               salt: int = 0) -> DataFrame:
    """The wide sales table. Date parts and total follow from a sale's source
    columns, so they are derived behind the joins: the shuffles of the sales
    carry the source columns only."""
    wide = enrich_sales(sales.select(*cleanse.RAW_SALES_COLUMNS), customers, catalog, scores, activity, salt)
    added = wide.columns[len(cleanse.RAW_SALES_COLUMNS):]
    return cleanse.add_total(cleanse.add_date_parts(wide)).select(*cleanse.SALES_COLUMNS, *added)
