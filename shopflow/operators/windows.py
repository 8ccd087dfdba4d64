"""Revenue share, best item of each month, month against the mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.columns import money_sum
from shopflow.functions.predicates import present
from shopflow.operators.kpis import each_sale, revenue, with_share


def revenue_share(items: DataFrame, dim: str = "categoria") -> DataFrame:
    """Revenue per ``dim`` value and its share of the classified revenue;
    ``items`` are sales or ``sold`` rows."""
    if "_ingresos" not in items.columns:
        items = each_sale(items, dim)
    agg = items.filter(present(dim)).groupBy(dim).agg(revenue().alias("ingresos_total"))
    return with_share(agg, "ingresos_total", "pct_ingresos")


# (key, label, output) of the three "best of the month" dimensions
MONTH_BEST = [("juego_id", "titulo", "juego_top"), ("categoria", "categoria", "categoria_top"),
              ("plataforma", "plataforma", "plataforma_top")]


def monthly_best(items: DataFrame, dims=MONTH_BEST) -> DataFrame:
    """W3 for several dimensions at once, one row per month; ``items`` are
    sales or ``sold`` rows with the month and the dimensions' columns.

    One pass: a GROUPING SETS aggregate over the summed sales sums units per
    (month, game), (month, category) and (month, platform) together; a
    second, small aggregate picks each month's arg-max per dimension
    (min over struct(-units, key, label): ties go to the smallest key).
    """
    cols = list(dict.fromkeys(c for k, l, _ in dims for c in (k, l)))
    sets = [["anio", "mes", *dict.fromkeys([k, l])] for k, l, _ in dims]
    if "_unidades" not in items.columns:
        items = each_sale(items, "anio", "mes", *cols)
    agg = (items.filter(present("anio", "mes"))
               .groupingSets(sets, "anio", "mes", *cols)
               .agg(F.sum("_unidades").alias("__u"), F.grouping_id().alias("__g")))
    n = len(cols)

    def gid(k, l):
        # grouping_id bit i (from the left, over anio, mes, *cols) is 1 when
        # that column is NOT grouped in the row's set
        grouped = {c for c in ("anio", "mes", k, l)}
        bits = 0
        for i, c in enumerate(["anio", "mes", *cols]):
            if c not in grouped:
                bits |= 1 << (n + 1 - i)
        return bits

    picks = []
    for k, l, out in dims:
        mine = (F.col("__g") == gid(k, l)) & present(k, l)
        best = F.min(F.when(mine, F.struct((-F.col("__u")).alias("nu"), F.col(k).alias("k"),
                                           F.col(l).alias("l"))))
        picks.append(best.getField("l").alias(out))
    return agg.groupBy("anio", "mes").agg(*picks)


def vs_mean(monthly: DataFrame, revenue: str = "ingresos_mes") -> DataFrame:
    """W4 over monthly rows: the mean month and each month's distance from
    it in percent, computed exactly on decimals.  The window sees one row
    per month."""
    allm = Window.partitionBy()
    rev = F.col(revenue).cast("decimal(22,2)")
    tot = F.sum(rev).over(allm)
    n = F.count(F.lit(1)).over(allm)
    dec = "decimal(38,0)"
    rev_c, tot_c = (rev * 100).cast(dec), (tot * 100).cast(dec)
    pct = F.round((rev_c * n - tot_c) * 100 / tot_c, 1)
    return monthly.withColumns({
        "media_mensual": F.round(tot / n, 2).cast("double"),
        "pct_vs_media": pct.cast("double"),
    })


def monthly_vs_mean(wide: DataFrame) -> DataFrame:
    """Monthly revenue, the mean month, and the month's distance from it
    in percent."""
    m = (wide.filter(present("anio", "mes")).groupBy("anio", "mes")
             .agg(money_sum("total").alias("ingresos_mes")))
    return vs_mean(m).select("anio", "mes", "ingresos_mes", "media_mensual", "pct_vs_media")
