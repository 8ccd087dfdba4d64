"""Map the driver's star-schema test tables onto the retail entities.

The test data is TPC-H-like (lineitem, orders, part, customer, nation,
events).  These adapters render it in the shape of the raw retail inputs --
string ids with padding and mixed case, free platform spellings, bad dates,
non-positive prices, duplicate sale ids, NULL names -- so the cleansing and
integration operators do real work.  Every rule here is deterministic and
mirrored by the DuckDB oracle SQL (``shopflow.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.columns import EVENT_TYPES, PAYMENT_METHODS, event_code
from shopflow.sinks.files import encode_messages, write_xml

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Fixture spellings (ours): l_returnflag -> (odd line spelling, even line spelling)
SALE_PLATFORM_SPELLING = {"A": ("PS5", " ps5"), "N": ("XBOX", "Xbox Series X"),
                          "R": ("switch ", "Nintendo Switch")}
# Catalogue platforms by p_size % 3, and inventory spellings by the same rule.
CATALOG_PLATFORMS = {0: ["PlayStation 5", "Xbox Series X"],
                     1: ["Xbox One", "XBOX Series S", "Nintendo Switch"],
                     2: ["Nintendo Switch"]}
INVENTORY_PLATFORMS = {0: ["PS5", "Xbox"], 1: ["Xbox", "Switch"], 2: ["Switch"]}
# events.event_type -> sale-event lifecycle type
EVENT_TYPE_MAP = {"view": EVENT_TYPES[0], "click": EVENT_TYPES[1], "signup": EVENT_TYPES[2],
                  "purchase": EVENT_TYPES[4], "error": EVENT_TYPES[5]}
STREAM_PLATFORMS = ["PS5", "Xbox", "Switch", "PC", "PlayStation 4"]


def session_key(spark: SparkSession) -> tuple[str, int]:
    """Identifies a live session: application id (new for every context)
    plus the session object, so a stopped session's DataFrames are never
    handed to its successor."""
    return spark.sparkContext.applicationId, id(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, listed anew: rewritten files are never read with an old listing."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col, mapping: dict, default=None):
    out = None
    for k, v in mapping.items():
        cond = col == F.lit(k)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default) if default is not None else out


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as a CSV would deliver them (ventas.csv, 9 columns, strings)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_returnflag", "l_discount", "l_tax")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
           .join(pt, li.l_partkey == pt.p_partkey, "inner"))
    even = (F.col("l_linenumber") % 2) == 0
    spelled = {k: F.when(even, F.lit(v[1])).otherwise(F.lit(v[0]))
               for k, v in SALE_PLATFORM_SPELLING.items()}
    sale_id = F.concat(F.lit("V"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return j.select(
        F.when((F.col("l_orderkey") % 53 == 0) & (F.col("l_linenumber") == 2), F.lit(None).cast("string")).otherwise(sale_id).alias("venta_id"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.lit("sin fecha"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("fecha"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cliente_id"),
        F.when(even, F.concat(F.lit(" p"), F.col("l_partkey").cast("string"), F.lit(" ")))
         .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("juego_id"),
        _case(F.col("l_returnflag"), spelled).alias("plataforma"),
        F.when(F.col("l_discount") >= 0.095, F.lit(0.0))
         .when((F.col("l_discount") <= 0.005) & (F.col("l_tax") <= 0.005), F.lit(None).cast("double"))
         .when((F.col("l_orderkey") % 97 == 0) & (F.col("l_linenumber") == 1), F.lit(1e17))
         .otherwise(F.col("p_retailprice") + (F.col("l_linenumber") % 3) * F.lit(0.005)).alias("precio"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("o_orderpriority").alias("metodo_pago"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("vendedor"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers (clientes.csv): padded district and membership, NULL names."""
    c = table(spark, sf_dir, "customer")
    # nation is a fixed 25-row table: a proven broadcast bound.
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("cliente_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("nombre"),
        (F.lit(18) + (F.col("c_custkey") % 60)).cast("int").alias("edad"),
        F.when((F.col("c_custkey") % 2) == 0, F.lit("F")).otherwise(F.lit("M")).alias("genero"),
        F.concat(F.lit(" "), F.col("n_name")).alias("distrito"),
        F.concat(F.col("c_mktsegment"), F.lit("  ")).alias("nivel_membresia"),
    )


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue (catalogo_juegos.json): platform arrays in long spellings,
    some games with no platforms, some with a missing category."""
    p = table(spark, sf_dir, "part")
    arrays = {k: F.array(*[F.lit(x) for x in v]) for k, v in CATALOG_PLATFORMS.items()}
    plats = (F.when((F.col("p_size") % 7) == 0, F.array().cast("array<string>"))
             .otherwise(_case(F.col("p_size") % 3, arrays)))
    pegi = _case(F.col("p_size") % 4, {0: F.lit(3), 1: F.lit(7), 2: F.lit(12), 3: F.lit(18)})
    return p.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("juego_id"),
        F.col("p_name").alias("titulo"),
        F.when(F.col("p_size") == 13, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("categoria"),
        plats.alias("plataformas"),
        F.col("p_retailprice").alias("precio_base"),
        F.col("p_brand").alias("desarrollador"),
        F.concat(F.lit("Pub "), F.col("p_brand")).alias("publicador"),
        (F.lit(2000) + (F.col("p_size") % 25)).cast("int").alias("anio_lanzamiento"),
        pegi.cast("int").alias("pegi"),
        F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(")")).alias("descripcion"),
        F.array(F.col("p_brand"), F.lower(F.col("p_type"))).alias("tags"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews (resenas.json) from events: error events carry no review id,
    signups no score."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("R"), F.col("event_id").cast("string"))).alias("resena_id"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("juego_id"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("double"))
         .otherwise((F.lit(1) + (F.col("event_id") % 5)).cast("double") + (F.col("event_id") % 7) * F.lit(0.001)).alias("puntuacion"),
        F.get_json_object("props", "$.k").cast("int").alias("util_votos"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity log (logs_tienda.txt) rendered from events, column ``value``.

    date time level customer EVENT [title]; error events become SISTEMA lines
    that mention PURCHASE; click lines carry doubled blanks; view lines carry
    a title token that holds the word PURCHASE.
    """
    e = table(spark, sf_dir, "events")
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    cust = F.concat(F.lit("C"), F.col("user_id").cast("string"))
    game = F.concat(F.lit("P"), (F.col("event_id") % 2000).cast("string"))
    t = F.col("event_type")
    line = (F.when(t == "purchase", F.concat_ws(" ", ts, F.lit("INFO"), cust, F.lit("PURCHASE"), game))
            .when(t == "signup", F.concat_ws(" ", ts, F.lit("INFO"), cust, F.lit("LOGIN")))
            .when(t == "view", F.concat_ws(" ", ts, F.lit("INFO"), cust, F.lit("VIEW_GAME"),
                                           F.concat(F.lit("PURCHASE-GUIDE-"), game)))
            .when(t == "click", F.concat_ws("  ", ts, F.lit("INFO"), cust, F.lit("ADD_CART"), game))
            .otherwise(F.concat_ws(" ", ts, F.lit("WARN"), F.lit("SISTEMA"), F.lit("PURCHASE"),
                                   F.lit("retry"), cust)))
    return e.select(line.alias("value"))


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory rows (inventario.xml flattened): raw platform spellings."""
    p = table(spark, sf_dir, "part")
    arrays = {k: F.array(*[F.lit(x) for x in v]) for k, v in INVENTORY_PLATFORMS.items()}
    return (p.select("p_partkey", "p_name", "p_size", "p_retailprice",
                     F.explode(_case(F.col("p_size") % 3, arrays)).alias("plataforma"))
             .select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("juego_id"),
                     F.col("p_name").alias("titulo_inv"),
                     F.col("plataforma"),
                     F.col("p_size").cast("int").alias("stock"),
                     F.col("p_retailprice").alias("precio_inv"),
                     (F.lit(5) + (F.col("p_partkey") % 10)).cast("int").alias("umbral")))


def sale_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale events as the producer would emit them (customer fields left for
    the stream to enrich).  Risk is three digits of ``value``; error events
    carry no flag."""
    e = table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("long")
    risk = (((cents * 7 + F.col("event_id")) % 1000) / F.lit(1000.0)).cast("double")
    qty = (F.lit(1) + (F.col("event_id") % 3)).cast("int")
    plat = F.element_at(F.array(*[F.lit(x) for x in STREAM_PLATFORMS]),
                        ((F.col("event_id") % len(STREAM_PLATFORMS)) + 1).cast("int"))
    pay = F.element_at(F.array(*[F.lit(x) for x in PAYMENT_METHODS]),
                       ((F.col("user_id") % len(PAYMENT_METHODS)) + 1).cast("int"))
    return e.select(
        event_code(F.col("event_id")).alias("event_id"),
        _case(F.col("event_type"), {k: F.lit(v) for k, v in EVENT_TYPE_MAP.items()}).alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_timestamp"),
        F.concat(F.lit("V"), F.col("event_id").cast("string")).alias("venta_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("cliente_id"),
        F.concat(F.lit("P"), (F.col("event_id") % 200).cast("string")).alias("juego_id"),
        plat.alias("plataforma"),
        pay.alias("metodo_pago"),
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("vendedor"),
        F.col("value").alias("precio"),
        qty.alias("cantidad"),
        F.round(F.col("value").cast("decimal(18,2)") * qty, 2).cast("double").alias("total"),
        F.lit(None).cast("string").alias("cliente_nombre"),
        F.lit(None).cast("string").alias("nivel_membresia"),
        F.lit(None).cast("string").alias("distrito"),
        risk.alias("riesgo_fraude"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("boolean"))
         .otherwise(risk >= F.lit(0.75)).alias("venta_riesgosa"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        # damaged deliveries (see sale_messages): 0 = no damage
        F.when((F.col("event_type") == "error") & ((F.col("event_id") % 10) == 0), F.lit(1))
         .when((F.col("event_type") == "error") & ((F.col("event_id") % 10) == 5), F.lit(2))
         .otherwise(F.lit(0)).alias("_damage"),
    )


def inventory_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory as nested rows shaped like inventario.xml: one row per game
    (``_id`` attribute, ``titulo``), platforms nested with a ``_nombre``
    attribute and stock, price and reorder threshold."""
    p = table(spark, sf_dir, "part")
    arrays = {k: F.array(*[F.lit(x) for x in v]) for k, v in INVENTORY_PLATFORMS.items()}
    stock = F.col("p_size").cast("int")
    umbral = (F.lit(5) + (F.col("p_partkey") % 10)).cast("int")
    plats = F.transform(_case(F.col("p_size") % 3, arrays), lambda x: F.struct(
        x.alias("_nombre"), stock.alias("stock"), F.col("p_retailprice").alias("precio"),
        umbral.alias("umbral_reposicion")))
    return p.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("_id"),
                    F.col("p_name").alias("titulo"),
                    F.struct(plats.alias("plataforma")).alias("plataformas"))


def sale_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale events encoded as broker messages (key = venta_id, value = JSON).

    Some error events arrive damaged: damage 1 loses the closing brace,
    damage 2 carries the quantity as text."""
    ev = sale_events(spark, sf_dir)
    msgs = encode_messages(ev, key="venta_id", timestamp="timestamp", exclude=["_damage"])
    value = (F.when(F.col("_damage") == 1, F.regexp_replace("value", "}$", ""))
              .when(F.col("_damage") == 2,
                    F.regexp_replace("value", '"cantidad":([0-9]+)', '"cantidad":"n$1"'))
              .otherwise(F.col("value")))
    return msgs.select("key", value.alias("value"), "timestamp")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Life-cycle messages of the orders: (key, value, timestamp, delivery).

    Each order is created at its date; seven of ten are paid within 0 to 6 days (some
    payments come twice), one of ten after 9 days, one of ten pays an unknown sale;
    a quarter is cancelled 0 to 5 days later. Deliveries follow event time; the last
    one holds a heartbeat of each type in the far future.
    """
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("d"), F.col("o_totalprice").alias("total"))
    k, sale = F.col("k"), F.concat(F.lit("V"), F.col("k").cast("string"))
    plat = F.element_at(F.array(*[F.lit(x) for x in STREAM_PLATFORMS]), (k % len(STREAM_PLATFORMS) + 1).cast("int"))

    def event(kind: str, who, days, times=F.lit(1)):
        return o.select(F.explode(F.array_repeat(F.struct(
            who.alias("venta_id"), F.lit(kind).alias("event_type"), (F.col("d") + F.make_dt_interval(days)).alias("timestamp"),
            plat.alias("plataforma"), F.col("total")), times.cast("int"))).alias("e")).select("e.*")

    paid = event(EVENT_TYPES[2], F.when(k % 10 == 8, F.concat(F.lit("X"), k.cast("string"))).otherwise(sale),
                 F.when(k % 10 == 7, 9).when(k % 10 == 8, 1).otherwise(k % 10).cast("int"), F.when(k % 10 == 9, 0).when(k % 10 == 1, 2).otherwise(1))
    rows = event(EVENT_TYPES[0], sale, F.lit(0)).union(paid).union(event(EVENT_TYPES[5], sale, (k % 6).cast("int"), F.when(k % 4 == 0, 1).otherwise(0)))
    year = F.year("timestamp")
    rows = rows.withColumn("delivery", F.when(year < 1994, 0).when(year < 1996, 1).otherwise(2))
    beat = spark.range(1).select(F.explode(F.array(*[F.struct(
        F.lit(f"latido-{t}").alias("venta_id"), F.lit(t).alias("event_type"), F.lit("2100-01-01").cast("timestamp").alias("timestamp"),
        F.lit("PC").alias("plataforma"), F.lit(0.0).alias("total")) for t in (EVENT_TYPES[0], EVENT_TYPES[2], EVENT_TYPES[5])])).alias("e")).select("e.*", F.lit(3).alias("delivery"))
    rows = rows.union(beat).withColumn("event_timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    return encode_messages(rows, key="venta_id", timestamp="timestamp", exclude=["delivery"])


def customer_deliveries(customers: DataFrame) -> DataFrame:
    """Three deliveries of the customer dimension (cliente_id, entrega, nivel_membresia, distrito).

    A seventh of the customers appears only from the second delivery on; a third changes
    its membership in the second, a quarter its district in the third; the others are
    delivered unchanged again.
    """
    k = F.substring("cliente_id", 2, 20).cast("long")
    days = [F.lit(f"2024-01-{d}").cast("timestamp") for d in ("01", "11", "21")]
    level = F.when(k % 3 == 0, "Plus").otherwise(F.col("nivel_membresia"))
    one = [customers.where(k % 7 != 0).select("cliente_id", days[0].alias("entrega"), "nivel_membresia", "distrito"),
           customers.select("cliente_id", days[1].alias("entrega"), level.alias("nivel_membresia"), "distrito"),
           customers.select("cliente_id", days[2].alias("entrega"), level.alias("nivel_membresia"), F.when(k % 4 == 0, "Lima").otherwise(F.col("distrito")).alias("distrito"))]
    return one[0].union(one[1]).union(one[2])


def game_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game documents as JSON text (column ``value``), some without a field,
    with an explicit null, or with a field of another type."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 10

    def field(name, value, quoted=True):
        return F.concat(F.lit(f'"{name}":'), F.concat(F.lit('"'), value, F.lit('"')) if quoted else value)

    parts = [
        field("juego_id", F.concat(F.lit("P"), F.col("p_partkey").cast("string"))),
        F.when(k == 3, F.lit(None)).otherwise(field("titulo", F.lit("Juego"))),
        F.when(k == 6, F.lit('"categoria":null')).otherwise(field("categoria", F.lit("RPG"))),
        F.when(k == 5, F.lit('"plataformas":"PS5"')).otherwise(F.lit('"plataformas":["PS5"]')),
        F.when(k == 4, F.lit('"precio_base":"caro"')).otherwise(F.lit('"precio_base":99.5')),
        F.when(k == 0, F.lit(None)).when(k == 1, F.lit('"pegi":null')).when(k == 2, F.lit('"pegi":"M"')).otherwise(F.lit('"pegi":12')),
    ]
    return p.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value"))


def write_damaged_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Raw files derived from the tables in which some records do not fit
    their schema: a quantity in words (CSV), cut-off or wrongly typed objects
    (JSON Lines), a stock in words (XML)."""
    orders, part, customer, events = (table(spark, sf_dir, t) for t in ("orders", "part", "customer", "events"))
    key = F.col("o_orderkey")
    sale = F.concat(F.lit("V"), key.cast("string"), F.lit(",2024-01-02,C1,P1,PS5,10.5,"), F.when(key % 40 == 0, F.lit("dos")).otherwise(F.lit("2")), F.lit(",Yape,S1"))
    sales_head = "venta_id,fecha,cliente_id,juego_id,plataforma,precio,cantidad,metodo_pago,vendedor"
    client = F.concat(F.lit("C"), F.col("c_custkey").cast("string"), F.lit(",Ana,"), F.when(F.col("c_custkey") % 30 == 0, F.lit("treinta")).otherwise(F.lit("30")), F.lit(",F,Lima,Gold"))
    client_head = "cliente_id,nombre,edad,genero,distrito,nivel_membresia"
    for name, df, line, head in (("ventas.csv", orders, sale, sales_head), ("clientes.csv", customer, client, client_head)):
        df.select(line.alias(head)).write.option("header", True).option("quote", "").option("escapeQuotes", False).option("sep", "\x01").csv(f"{root}/{name}")
    k = F.col("p_partkey")
    game = F.concat(F.lit('{"juego_id":"P'), k.cast("string"), F.when(k % 50 == 0, F.lit('","titulo":"T"')).when(k % 50 == 1, F.lit('","precio_base":"caro"}')).otherwise(F.lit('","precio_base":9.5}')))
    part.select(game.alias("value")).write.text(f"{root}/catalogo_juegos.json")
    e = F.col("event_id")
    review = F.concat(F.lit('{"resena_id":"R'), e.cast("string"), F.when(e % 70 == 0, F.lit('","puntuacion":"alta"}')).otherwise(F.lit('","puntuacion":4.5}')))
    events.select(review.alias("value")).write.text(f"{root}/resenas.json")
    stock = F.when(k % 45 == 0, F.lit("tres")).otherwise(F.lit("3"))
    item = F.struct(F.lit("PS5").alias("_nombre"), stock.alias("stock"), F.lit(9.5).alias("precio"), F.lit(5).alias("umbral_reposicion"))
    games = part.select(F.concat(F.lit("P"), k.cast("string")).alias("_id"), F.lit("T").alias("titulo"), F.struct(F.array(item).alias("plataforma")).alias("plataformas"))
    write_xml(games, f"{root}/inventario.xml", "juego", "inventario")


#: Deliveries of ``sale_deliveries``; the last one repeats the one before it.
SALE_DELIVERIES = 4


def sale_deliveries(sales: DataFrame) -> list[DataFrame]:
    """Raw sales as they would arrive: up to 1999 (and bad dates), from 2000 on,
    corrections that move some sales of early 2000 by 40 days, the corrections again."""
    early = F.coalesce(F.try_to_date("fecha", "yyyy-MM-dd") < F.lit("2000-01-01").cast("date"), F.lit(True))
    moved = sales.filter((F.substring("fecha", 1, 6) == "2000-0") & F.substring("fecha", 7, 1).isin("1", "2", "3") & F.col("venta_id").endswith("-3"))
    moved = moved.withColumn("fecha", F.date_format(F.date_add(F.to_date("fecha", "yyyy-MM-dd"), 40), "yyyy-MM-dd"))
    return [sales.filter(early), sales.filter(~early), moved, moved]


def customers_at(customers: DataFrame, delivery: int) -> DataFrame:
    """The customers as of a sale delivery: one is a newcomer until the last."""
    if delivery == SALE_DELIVERIES - 1:
        return customers
    return customers.withColumn("nivel_membresia", F.when(F.col("cliente_id") == "C7", F.lit("Nuevo")).otherwise(F.col("nivel_membresia")))
