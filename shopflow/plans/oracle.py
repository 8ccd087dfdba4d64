"""DuckDB SQL that recomputes every registered query independently.

Written against the raw test tables (views region ... conversations). The
adapter rules and the cleansing rules are restated here as SQL, with their own
literals: nothing is imported from the code under test, so a wrong rule
there shows as a difference. Products and averages are computed from unrounded
decimals and rounded half-up once, in integers.
"""

from __future__ import annotations

# Fixed values, as SQL sees them.
PLATFORM_RULES = [("XBOX", "XBOX"), ("PS5", "PS5"), ("PS4", "PS4"), ("SWITCH", "SWITCH"), ("PC", "PC"),
                  ("PLAYSTATION 5", "PS5"), ("PLAYSTATION 4", "PS4"), ("NINTENDO", "SWITCH")]
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
PAYMENTS = ["Efectivo", "Yape", "Plin", "Tarjeta Crédito", "Tarjeta Débito"]
STREAM_PLATFORMS = ["PS5", "Xbox", "Switch", "PC", "PlayStation 4"]
CATALOG_PLATFORMS = {0: ["PlayStation 5", "Xbox Series X"], 1: ["Xbox One", "XBOX Series S", "Nintendo Switch"], 2: ["Nintendo Switch"]}
INVENTORY_PLATFORMS = {0: ["PS5", "Xbox"], 1: ["Xbox", "Switch"], 2: ["Switch"]}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(items) -> str:
    return "[" + ", ".join(q(x) for x in items) + "]"


def platform(x: str) -> str:
    inner = f"upper(trim({x}))"
    whens = " ".join(f"WHEN contains({inner}, {q(n)}) THEN {q(l)}" for n, l in PLATFORM_RULES)
    return f"(CASE {whens} ELSE {inner} END)"


def money_sum(x: str) -> str:
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(18,2))), 2) AS DOUBLE)"


def cents(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(18,2)) * 100) AS HUGEINT)"


def millionths(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(24,6)) * 1000000 AS HUGEINT)"


def avg2(x: str) -> str:
    """round(avg(x), 2) half-up, exact, for non-negative values of up to six decimals."""
    n = f"NULLIF(COUNT({x}), 0)"
    return f"(CAST((SUM({millionths(x)}) * 2 + 10000 * {n}) // (20000 * {n}) AS DOUBLE) / 100)"


def pct1(part: str, whole: str) -> str:
    """round(part * 100 / whole, 1) half-up, exact, for non-negative integers."""
    return f"(CAST((CAST({part} AS HUGEINT) * 2000 + ({whole})) // (2 * ({whole})) AS DOUBLE) / 10)"


def rn(partition: str, order_cols: list[str], desc: bool = True) -> str:
    d = "DESC NULLS LAST" if desc else "ASC NULLS FIRST"
    return (f"ROW_NUMBER() OVER (PARTITION BY {partition} ORDER BY "
            + ", ".join(f"{c} {d}" for c in order_cols) + ")")


SALES_COLS = ["venta_id", "fecha", "cliente_id", "juego_id", "plataforma", "precio",
              "cantidad", "metodo_pago", "vendedor", "mes", "anio", "trimestre", "total"]
RAW_SALES_COLS = ["venta_id", "fecha", "cliente_id", "juego_id", "plataforma", "precio",
                  "cantidad", "metodo_pago", "vendedor"]
CUSTOMER_COLS = ["cliente_id", "nombre", "edad", "genero", "distrito", "nivel_membresia"]
CATALOG_COLS = ["juego_id", "titulo", "categoria", "plataforma", "precio_base",
                "desarrollador", "anio_lanzamiento", "pegi", "tags"]
WIDE_EXTRA = ["nombre", "edad", "genero", "distrito", "nivel_membresia", "titulo", "categoria",
              "desarrollador", "anio_lanzamiento", "tags", "puntuacion_promedio",
              "total_resenas", "total_votos_util", "compras_en_log", "sesiones_log"]
WIDE_COLS = SALES_COLS + WIDE_EXTRA


SALE_PLATFORM = """(CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_linenumber % 2 = 0 THEN ' ps5' ELSE 'PS5' END
            WHEN l_returnflag = 'N' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'Xbox Series X' ELSE 'XBOX' END
            WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'Nintendo Switch' ELSE 'switch ' END END)"""


def _array_case(expr: str, mapping: dict) -> str:
    return "(CASE " + " ".join(f"WHEN {expr} = {k} THEN {lst(v)}" for k, v in mapping.items()) + " END)"


CTES = {
    "raw_sales": f"""
SELECT CASE WHEN l_orderkey % 53 = 0 AND l_linenumber = 2 THEN NULL
            ELSE 'V' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS venta_id,
       CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'sin fecha'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fecha,
       'C' || CAST(o_custkey AS VARCHAR) AS cliente_id,
       CASE WHEN l_linenumber % 2 = 0 THEN ' p' || CAST(l_partkey AS VARCHAR) || ' '
            ELSE 'P' || CAST(l_partkey AS VARCHAR) END AS juego_id,
       {SALE_PLATFORM} AS plataforma,
       CASE WHEN l_discount >= 0.095 THEN CAST(0.0 AS DOUBLE)
            WHEN l_discount <= 0.005 AND l_tax <= 0.005 THEN CAST(NULL AS DOUBLE)
            WHEN l_orderkey % 97 = 0 AND l_linenumber = 1 THEN CAST(1e17 AS DOUBLE)
            ELSE p_retailprice + (l_linenumber % 3) * CAST(0.005 AS DOUBLE) END AS precio,
       CAST(l_quantity AS INTEGER) AS cantidad,
       o_orderpriority AS metodo_pago,
       'S' || CAST(l_suppkey AS VARCHAR) AS vendedor
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "sales_n": f"""
SELECT trim(venta_id) AS venta_id, CAST(try_strptime(fecha, '%Y-%m-%d') AS DATE) AS fecha,
       upper(trim(cliente_id)) AS cliente_id, upper(trim(juego_id)) AS juego_id,
       {platform('plataforma')} AS plataforma, precio, cantidad, metodo_pago, vendedor,
       CASE WHEN venta_id IS NULL THEN 'venta_id nulo'
            WHEN precio > 0 AND precio * cantidad >= 1e16 THEN 'precio fuera de rango' END AS motivo
FROM raw_sales""",
    "sales_c": "SELECT * EXCLUDE (motivo) FROM sales_n WHERE motivo IS NULL AND precio > 0",
    "sales_d": f"""
SELECT *, CAST(month(fecha) AS INTEGER) AS mes, CAST(year(fecha) AS INTEGER) AS anio,
       CAST(quarter(fecha) AS INTEGER) AS trimestre,
       CAST(CAST(({millionths('precio')} * cantidad + 5000) // 10000 AS HUGEINT) AS DOUBLE) / 100 AS total
FROM sales_c""",
    "sales": f"""
SELECT {', '.join(SALES_COLS)} FROM (
  SELECT *, {rn('venta_id', [c for c in SALES_COLS if c != 'venta_id'])} AS rn_ FROM sales_d)
WHERE rn_ = 1""",
    "raw_customers": """
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS cliente_id,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS nombre,
       CAST(18 + c_custkey % 60 AS INTEGER) AS edad,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS genero,
       ' ' || n_name AS distrito,
       c_mktsegment || '  ' AS nivel_membresia
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "customers": f"""
SELECT {', '.join(CUSTOMER_COLS)} FROM (
  SELECT *, {rn('cliente_id', CUSTOMER_COLS[1:])} AS rn_ FROM (
    SELECT upper(trim(cliente_id)) AS cliente_id, nombre, edad, genero,
           trim(distrito) AS distrito, trim(nivel_membresia) AS nivel_membresia
    FROM raw_customers))
WHERE rn_ = 1""",
    "raw_catalog": f"""
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS juego_id, p_name AS titulo,
       CASE WHEN p_size = 13 THEN NULL ELSE p_type END AS categoria,
       CASE WHEN p_size % 7 = 0 THEN CAST([] AS VARCHAR[])
            ELSE {_array_case('p_size % 3', CATALOG_PLATFORMS)} END AS plataformas,
       p_retailprice AS precio_base, p_brand AS desarrollador, 'Pub ' || p_brand AS publicador,
       CAST(2000 + p_size % 25 AS INTEGER) AS anio_lanzamiento,
       CAST(CASE p_size % 4 WHEN 0 THEN 3 WHEN 1 THEN 7 WHEN 2 THEN 12 WHEN 3 THEN 18 END AS INTEGER) AS pegi,
       p_name || ' (' || p_type || ')' AS descripcion,
       [p_brand, lower(p_type)] AS tags
FROM part""",
    "catalog": f"""
SELECT {', '.join(CATALOG_COLS)} FROM (
  SELECT *, {rn('juego_id, plataforma', [c for c in CATALOG_COLS if c not in ('juego_id', 'plataforma')])} AS rn_
  FROM (SELECT upper(trim(juego_id)) AS juego_id, titulo, categoria, {platform('plat')} AS plataforma,
               precio_base, desarrollador, anio_lanzamiento, pegi, tags
        FROM (SELECT *, unnest(plataformas) AS plat FROM raw_catalog)))
WHERE rn_ = 1""",
    "raw_reviews": """
SELECT CASE WHEN event_type = 'error' THEN NULL ELSE 'R' || CAST(event_id AS VARCHAR) END AS resena_id,
       'P' || CAST(user_id AS VARCHAR) AS juego_id,
       CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(1 + event_id % 5 AS DOUBLE) + (event_id % 7) * CAST(0.001 AS DOUBLE) END AS puntuacion,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS util_votos
FROM events""",
    "scores": f"""
SELECT upper(trim(juego_id)) AS juego_id, {avg2('puntuacion')} AS puntuacion_promedio,
       COUNT(resena_id) AS total_resenas, CAST(SUM(util_votos) AS BIGINT) AS total_votos_util
FROM raw_reviews GROUP BY 1""",
    "activity": """
SELECT 'C' || CAST(user_id AS VARCHAR) AS cliente_id,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS compras_en_log,
       COUNT(*) FILTER (WHERE event_type = 'signup') AS sesiones_log
FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1""",
    "raw_inventory": f"""
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS juego_id, p_name AS titulo_inv,
       unnest({_array_case('p_size % 3', INVENTORY_PLATFORMS)}) AS plataforma,
       CAST(p_size AS INTEGER) AS stock, p_retailprice AS precio_inv,
       CAST(5 + p_partkey % 10 AS INTEGER) AS umbral
FROM part""",
    "inventory": f"""
SELECT upper(trim(juego_id)) AS juego_id, titulo_inv, {platform('plataforma')} AS plataforma,
       stock, precio_inv, umbral
FROM raw_inventory""",
    "wide": f"""
SELECT s.*, c.nombre, c.edad, c.genero, c.distrito, c.nivel_membresia,
       k.titulo, k.categoria, k.desarrollador, k.anio_lanzamiento, k.tags,
       r.puntuacion_promedio, r.total_resenas, r.total_votos_util,
       a.compras_en_log, a.sesiones_log
FROM sales s
LEFT JOIN customers c ON s.cliente_id = c.cliente_id
LEFT JOIN catalog k ON s.juego_id = k.juego_id AND s.plataforma = k.plataforma
LEFT JOIN scores r ON s.juego_id = r.juego_id
LEFT JOIN activity a ON s.cliente_id = a.cliente_id""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    ctes = dict(CTES)
    ctes.update(extra or {})
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


def text_columns(cols) -> str:
    """Columns with arrays as '|'-joined text."""
    return ", ".join(f"array_to_string({c}, '|') AS {c}" if c in ("tags", "plataformas") else c for c in cols)


SQL: dict[str, str] = {}

SQL["clean_sales"] = with_ctes(f"SELECT {', '.join(SALES_COLS)} FROM sales")

SQL["rejected_sales"] = with_ctes(f"SELECT {', '.join(RAW_SALES_COLS)}, motivo FROM sales_n WHERE motivo IS NOT NULL")

SQL["dedupe_latest"] = with_ctes(f"""
SELECT {', '.join(RAW_SALES_COLS)} FROM (
  SELECT *, {rn('venta_id', RAW_SALES_COLS[1:])} AS rn_ FROM raw_sales WHERE venta_id IS NOT NULL) WHERE rn_ = 1""")

SQL["canonical_platform"] = with_ctes(f"""
SELECT 'ventas' AS fuente, plataforma AS plataforma_original, {platform('plataforma')} AS plataforma,
       COUNT(*) AS filas FROM raw_sales GROUP BY plataforma
UNION ALL
SELECT 'catalogo', plat, {platform('plat')}, COUNT(*)
FROM (SELECT unnest(plataformas) AS plat FROM raw_catalog) GROUP BY plat
UNION ALL
SELECT 'inventario', plataforma, {platform('plataforma')}, COUNT(*) FROM raw_inventory GROUP BY plataforma""")

SQL["catalog_exploded"] = with_ctes(f"SELECT {text_columns(CATALOG_COLS)} FROM catalog")

SQL["review_scores"] = with_ctes("SELECT juego_id, puntuacion_promedio, total_resenas, total_votos_util FROM scores")

SQL["log_activity"] = with_ctes("SELECT cliente_id, compras_en_log, sesiones_log FROM activity")

SQL["wide_sales"] = with_ctes(f"SELECT {text_columns(WIDE_COLS)} FROM wide")

SQL["kpi_top_products"] = with_ctes(f"""
SELECT juego_id, titulo, categoria, CAST(SUM(cantidad) AS BIGINT) AS total_unidades,
       COUNT(venta_id) AS num_transacciones, {money_sum('total')} AS ingresos_total,
       {avg2('puntuacion_promedio')} AS rating_promedio
FROM wide WHERE titulo IS NOT NULL
GROUP BY juego_id, titulo, categoria
ORDER BY total_unidades DESC, juego_id ASC LIMIT 10""")

SQL["kpi_categories"] = with_ctes(f"""
SELECT categoria, num_ventas, total_unidades, ingresos_total, precio_promedio,
       {pct1('num_ventas', 'SUM(num_ventas) OVER ()')} AS pct_ventas
FROM (SELECT categoria, COUNT(venta_id) AS num_ventas, CAST(SUM(cantidad) AS BIGINT) AS total_unidades,
             {money_sum('total')} AS ingresos_total, {avg2('precio')} AS precio_promedio
      FROM wide WHERE categoria IS NOT NULL GROUP BY categoria)""")

SQL["kpi_platforms"] = with_ctes(f"""
SELECT a.plataforma, num_ventas, total_unidades, ingresos_total, ticket_promedio,
       {pct1('num_ventas', 'SUM(num_ventas) OVER ()')} AS cuota_mercado_pct,
       CAST(COALESCE(st.stock, 0) AS BIGINT) AS stock_actual
FROM (SELECT plataforma, COUNT(venta_id) AS num_ventas, CAST(SUM(cantidad) AS BIGINT) AS total_unidades,
             {money_sum('total')} AS ingresos_total, {avg2('precio')} AS ticket_promedio
      FROM wide GROUP BY plataforma) a
LEFT JOIN (SELECT plataforma, SUM(stock) AS stock FROM inventory GROUP BY plataforma) st
  ON a.plataforma = st.plataforma""")

SQL["kpi_monthly"] = with_ctes(f"""
SELECT anio, mes, COUNT(venta_id) AS num_transacciones, CAST(SUM(cantidad) AS BIGINT) AS total_unidades,
       {money_sum('total')} AS ingresos_mes, {avg2('total')} AS ticket_promedio,
       COUNT(DISTINCT cliente_id) AS clientes_unicos
FROM wide GROUP BY anio, mes""")

SQL["kpi_top_customers"] = with_ctes(f"""
SELECT cliente_id, nombre, nivel_membresia, distrito, COUNT(venta_id) AS num_compras,
       {money_sum('total')} AS gasto_total, {avg2('total')} AS ticket_promedio,
       MAX(fecha) AS ultima_compra
FROM wide WHERE nombre IS NOT NULL
GROUP BY cliente_id, nombre, nivel_membresia, distrito
ORDER BY gasto_total DESC, cliente_id ASC LIMIT 10""")

SQL["kpi_payment_by_segment"] = with_ctes("""
SELECT nivel_membresia, metodo_pago, COUNT(*) AS frecuencia
FROM wide WHERE nivel_membresia IS NOT NULL GROUP BY nivel_membresia, metodo_pago""")

SQL["kpi_low_stock"] = with_ctes("""
SELECT juego_id, titulo_inv AS titulo, plataforma, stock, umbral, precio_inv AS precio
FROM inventory WHERE stock <= umbral""")

SQL["kpi_summary"] = with_ctes(f"""
SELECT COUNT(venta_id) AS total_ventas, CAST(SUM(cantidad) AS BIGINT) AS total_unidades_vendidas,
       {money_sum('total')} AS ingresos_totales_soles, {avg2('total')} AS ticket_promedio,
       COUNT(DISTINCT cliente_id) AS clientes_activos, COUNT(DISTINCT juego_id) AS juegos_vendidos
FROM wide""")


# --- shared pieces for the second group of queries --------------------------
GAME_COLS = ["juego_id", "titulo", "categoria", "plataformas", "precio_base", "desarrollador",
             "publicador", "anio_lanzamiento", "pegi", "descripcion", "tags"]
MONTHS = "anio IS NOT NULL AND mes IS NOT NULL"


def half_up_signed(num: str, den: str, scale: int) -> str:
    """round(num * scale / den) half away from zero, den > 0, as integer."""
    return (f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * "
            f"((abs({num}) * {2 * scale} + ({den})) // (2 * ({den})))")


def best_of_month(key: str, label: str, out: str) -> str:
    lab = f", {label}" if label != key else ""
    return f"""
SELECT anio, mes, {label} AS {out} FROM (
  SELECT anio, mes, {key}{lab},
         ROW_NUMBER() OVER (PARTITION BY anio, mes ORDER BY SUM(cantidad) DESC, {key} ASC, {label} ASC) AS rn_
  FROM wide WHERE {MONTHS} AND {key} IS NOT NULL AND {label} IS NOT NULL
  GROUP BY anio, mes, {key}{lab}) WHERE rn_ = 1"""


MORE = {
    "games": f"""
SELECT {', '.join(GAME_COLS)} FROM (
  SELECT *, {rn('juego_id', GAME_COLS[1:])} AS rn_ FROM (
    SELECT upper(trim(juego_id)) AS juego_id, {', '.join(GAME_COLS[1:])} FROM raw_catalog))
WHERE rn_ = 1""",
    "kpi1": f"""
SELECT juego_id, titulo, categoria, CAST(SUM(cantidad) AS BIGINT) AS total_unidades,
       COUNT(venta_id) AS num_transacciones, {money_sum('total')} AS ingresos_total
FROM wide WHERE titulo IS NOT NULL GROUP BY juego_id, titulo, categoria
ORDER BY total_unidades DESC, juego_id ASC LIMIT 10""",
    "kpi3": f"""
SELECT plataforma, COUNT(venta_id) AS num_ventas, {money_sum('total')} AS ingresos_total
FROM wide GROUP BY plataforma""",
    "kpi4": f"""
SELECT anio, mes, COUNT(venta_id) AS num_transacciones, CAST(SUM(cantidad) AS BIGINT) AS total_unidades,
       {money_sum('total')} AS ingresos_mes, {avg2('total')} AS ticket_promedio,
       COUNT(DISTINCT cliente_id) AS clientes_unicos
FROM wide GROUP BY anio, mes""",
    "kpi5": f"""
SELECT cliente_id, nombre, {money_sum('total')} AS gasto_total
FROM wide WHERE nombre IS NOT NULL GROUP BY cliente_id, nombre, nivel_membresia, distrito
ORDER BY gasto_total DESC, cliente_id ASC LIMIT 10""",
    "kpi7": "SELECT juego_id, titulo_inv AS titulo, plataforma, stock FROM inventory WHERE stock <= umbral",
    "mbest": f"""
SELECT m.anio, m.mes, g.juego_top, c.categoria_top, p.plataforma_top
FROM (SELECT DISTINCT anio, mes FROM wide WHERE {MONTHS}) m
LEFT JOIN ({best_of_month('juego_id', 'titulo', 'juego_top')}) g ON m.anio = g.anio AND m.mes = g.mes
LEFT JOIN ({best_of_month('categoria', 'categoria', 'categoria_top')}) c ON m.anio = c.anio AND m.mes = c.mes
LEFT JOIN ({best_of_month('plataforma', 'plataforma', 'plataforma_top')}) p ON m.anio = p.anio AND m.mes = p.mes""",
    "mmean": f"""
SELECT anio, mes, CAST(c AS DOUBLE) / 100 AS ingresos_mes,
       CAST((SUM(c) OVER () * 2 + COUNT(*) OVER ()) // (2 * COUNT(*) OVER ()) AS DOUBLE) / 100 AS media_mensual,
       CAST({half_up_signed('c * COUNT(*) OVER () - SUM(c) OVER ()', 'SUM(c) OVER ()', 1000)} AS DOUBLE) / 10
         AS pct_vs_media
FROM (SELECT anio, mes, SUM({cents('total')}) AS c FROM wide WHERE {MONTHS} GROUP BY anio, mes)""",
    "sev": f"""
SELECT printf('EVT-%06d', event_id) AS event_id,
       CASE event_type WHEN 'view' THEN 'venta_creada' WHEN 'click' THEN 'venta_confirmada' WHEN 'signup' THEN 'pago_aprobado'
            WHEN 'purchase' THEN 'venta_completada' WHEN 'error' THEN 'venta_cancelada' END AS event_type,
       date_trunc('second', ts) AS event_timestamp,
       'V' || CAST(event_id AS VARCHAR) AS venta_id, 'C' || CAST(user_id AS VARCHAR) AS cliente_id,
       'P' || CAST(event_id % 200 AS VARCHAR) AS juego_id,
       {lst(STREAM_PLATFORMS)}[event_id % {len(STREAM_PLATFORMS)} + 1] AS plataforma_raw,
       {lst(PAYMENTS)}[user_id % {len(PAYMENTS)} + 1] AS metodo_pago,
       'S' || CAST(user_id % 10 AS VARCHAR) AS vendedor,
       value AS precio, CAST(1 + event_id % 3 AS INTEGER) AS cantidad,
       CAST(ROUND(CAST(value AS DECIMAL(18,2)) * (1 + event_id % 3), 2) AS DOUBLE) AS total,
       CAST((CAST(round(value * 100) AS BIGINT) * 7 + event_id) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS riesgo_fraude,
       CASE WHEN event_type = 'error' THEN NULL
            ELSE (CAST(round(value * 100) AS BIGINT) * 7 + event_id) % 1000 >= 750 END AS venta_riesgosa,
       (event_type = 'error' AND event_id % 10 IN (0, 5)) AS damaged, event_id AS n, ts
FROM events""",
    "senr": f"""
SELECT e.event_id, e.event_type, e.event_timestamp, e.venta_id, e.cliente_id, e.juego_id,
       {platform('e.plataforma_raw')} AS plataforma, e.metodo_pago, e.vendedor, e.precio, e.cantidad,
       e.total,
       COALESCE(c.nombre, 'desconocido') AS cliente_nombre,
       COALESCE(c.nivel_membresia, 'Normal') AS nivel_membresia,
       COALESCE(c.distrito, 'Desconocido') AS distrito,
       e.riesgo_fraude, e.venta_riesgosa, e.n % 3 AS batch_id
FROM sev e LEFT JOIN customers c ON e.cliente_id = c.cliente_id
WHERE NOT e.damaged""",
}


def w(body: str) -> str:
    return with_ctes(body, MORE)


SQL["revenue_share"] = w(f"""
SELECT categoria, ingresos_total, {pct1('c', 'SUM(c) OVER ()')} AS pct_ingresos
FROM (SELECT categoria, {money_sum('total')} AS ingresos_total, SUM({cents('total')}) AS c
      FROM wide WHERE categoria IS NOT NULL GROUP BY categoria)""")

SQL["monthly_best"] = w("SELECT * FROM mbest")

SQL["monthly_vs_mean"] = w("SELECT * FROM mmean")

SQL["null_profile"] = w("\nUNION ALL\n".join(
    f"SELECT {q(c)} AS columna, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos, COUNT(*) AS filas FROM wide"
    for c in WIDE_COLS))

_RULES = [("falta juego_id", "juego_id IS NULL"), ("falta titulo", "titulo IS NULL"),
          ("falta categoria", "categoria IS NULL"), ("falta precio_base", "precio_base IS NULL"),
          ("precio_base no positivo", "precio_base <= 0"), ("pegi fuera de rango", "pegi NOT IN (3, 7, 12, 16, 18)")]


def report(rules, source: str) -> str:
    return f"""SELECT juego_id, motivos = '' AS valido, motivos FROM (
  SELECT juego_id, concat_ws('; ', {', '.join(f'CASE WHEN {c} THEN {q(r)} END' for r, c in rules)}) AS motivos
  FROM {source})"""


SQL["validate_values"] = w(report(_RULES, "games"))

SQL["validate_documents"] = w(report(
    [("falta titulo", "k = 3"), ("tipo categoria", "k = 6"), ("tipo plataformas", "k = 5"), ("tipo precio_base", "k = 4"), ("tipo pegi", "k IN (1, 2)")],
    "(SELECT 'P' || CAST(p_partkey AS VARCHAR) AS juego_id, p_partkey % 10 AS k FROM part)"))

SQL["key_uniqueness"] = w("""
SELECT 'ventas_procesadas' AS coleccion, 'venta_id' AS clave, COUNT(*) AS filas,
       COUNT(DISTINCT venta_id) + MAX(CASE WHEN venta_id IS NULL THEN 1 ELSE 0 END) AS claves,
       COUNT(*) - COUNT(DISTINCT venta_id) - MAX(CASE WHEN venta_id IS NULL THEN 1 ELSE 0 END) AS repetidas FROM raw_sales
UNION ALL SELECT 'juegos', 'juego_id', COUNT(*), COUNT(DISTINCT juego_id), COUNT(*) - COUNT(DISTINCT juego_id) FROM raw_catalog""")

SQL["risk_flags"] = w("SELECT event_id, riesgo_fraude, riesgo_fraude >= 0.75 AS alto_riesgo FROM sev")

SQL["rejected_rows"] = """
SELECT 'ventas.csv' AS archivo, 'V' || CAST(o_orderkey AS VARCHAR) AS clave,
       'V' || CAST(o_orderkey AS VARCHAR) || ',2024-01-02,C1,P1,PS5,10.5,dos,Yape,S1' AS registro FROM orders WHERE o_orderkey % 40 = 0
UNION ALL SELECT 'clientes.csv', 'C' || CAST(c_custkey AS VARCHAR), 'C' || CAST(c_custkey AS VARCHAR) || ',Ana,treinta,F,Lima,Gold'
FROM customer WHERE c_custkey % 30 = 0
UNION ALL SELECT 'catalogo_juegos.json', 'P' || CAST(p_partkey AS VARCHAR), '{"juego_id":"P' || CAST(p_partkey AS VARCHAR) ||
       CASE WHEN p_partkey % 50 = 0 THEN '","titulo":"T"' ELSE '","precio_base":"caro"}' END FROM part WHERE p_partkey % 50 IN (0, 1)
UNION ALL SELECT 'resenas.json', 'R' || CAST(event_id AS VARCHAR), '{"resena_id":"R' || CAST(event_id AS VARCHAR) || '","puntuacion":"alta"}'
FROM events WHERE event_id % 70 = 0
UNION ALL SELECT 'inventario.xml', 'P' || CAST(p_partkey AS VARCHAR), '{"_id":"P' || CAST(p_partkey AS VARCHAR) || '","titulo":"T"}' FROM part WHERE p_partkey % 45 = 0"""

SQL["duplicate_keys"] = w("""
SELECT venta_id, COUNT(*) AS repeticiones FROM raw_sales GROUP BY venta_id HAVING COUNT(*) > 1""")

SQL["orphan_keys"] = w("""
SELECT 'juego_plataforma' AS entidad, juego_id || '|' || plataforma AS clave, COUNT(*) AS filas
FROM sales s WHERE NOT EXISTS (SELECT 1 FROM catalog k WHERE k.juego_id = s.juego_id AND k.plataforma = s.plataforma)
GROUP BY juego_id, plataforma
UNION ALL
SELECT 'cliente', cliente_id, COUNT(*) FROM sales s
WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.cliente_id = s.cliente_id) GROUP BY cliente_id""")

SQL["product_profile_docs"] = w(f"""
SELECT g.juego_id, g.titulo, g.categoria, g.precio_base, g.desarrollador, g.publicador,
       g.anio_lanzamiento, g.pegi, g.descripcion, array_to_string(g.plataformas, '|') AS plataformas, array_to_string(g.tags, '|') AS tags,
       CAST(COALESCE(u, 0) AS BIGINT) AS total_ventas_unidades,
       COALESCE(r, CAST(0 AS DOUBLE)) AS ingresos_acumulados,
       s.puntuacion_promedio, CAST(COALESCE(s.total_resenas, 0) AS BIGINT) AS total_resenas
FROM games g
LEFT JOIN (SELECT juego_id, SUM(cantidad) AS u, {money_sum('total')} AS r FROM wide GROUP BY juego_id) t
  ON g.juego_id = t.juego_id
LEFT JOIN scores s ON g.juego_id = s.juego_id""")

SQL["monthly_report_docs"] = w(f"""
SELECT k.anio, k.mes, {lst(MONTH_NAMES)}[k.mes] AS nombre_mes, k.num_transacciones, k.total_unidades,
       k.ingresos_mes, k.ticket_promedio, k.clientes_unicos, b.juego_top, b.categoria_top, b.plataforma_top,
       printf('%.1f', abs(m.pct_vs_media)) || '% ' ||
       CASE WHEN m.pct_vs_media >= 0 THEN 'por encima' ELSE 'por debajo' END || ' de la media mensual'
         AS observacion
FROM kpi4 k LEFT JOIN mbest b ON k.anio = b.anio AND k.mes = b.mes
LEFT JOIN mmean m ON k.anio = m.anio AND k.mes = m.mes
WHERE k.anio IS NOT NULL AND k.mes IS NOT NULL""")

SQL["sales_docs"] = w("""
SELECT venta_id, CAST(fecha AS VARCHAR) AS fecha, mes, anio, trimestre, cliente_id, nombre, edad, genero,
       distrito, nivel_membresia, juego_id, titulo, categoria, plataforma, precio, cantidad, total,
       metodo_pago, vendedor, puntuacion_promedio, total_resenas
FROM wide""")


def _money_text(x: str) -> str:
    return f"'S/' || format('{{:,}}', ({cents(x)} + 50) // 100)"


SQL["chart_series"] = w(f"""
SELECT 'top_juegos' AS serie, titulo AS etiqueta, CAST(total_unidades AS DOUBLE) AS valor,
       format('{{:,}}', total_unidades) AS texto FROM kpi1
UNION ALL SELECT 'plataformas', plataforma, ingresos_total, {_money_text('ingresos_total')} FROM kpi3
UNION ALL SELECT 'ventas_mensuales', CAST(anio AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0'),
       ingresos_mes, {_money_text('ingresos_mes')} FROM kpi4 WHERE anio IS NOT NULL AND mes IS NOT NULL
UNION ALL SELECT 'top_clientes', nombre, gasto_total, {_money_text('gasto_total')} FROM kpi5
UNION ALL SELECT 'stock_bajo', titulo || ' (' || plataforma || ')', CAST(stock AS DOUBLE),
       format('{{:,}}', stock) FROM kpi7""")

SQL["charts_from_csv"] = SQL["chart_series"]

SQL["run_metadata"] = w("""
SELECT 'shopflow' AS pipeline, '1.0' AS version, 'COMPLETADO' AS estado,
       'ventas_procesadas|analisis_juegos|analisis_categorias|analisis_plataformas|reportes_mensuales|perfil_clientes|alertas_inventario' AS colecciones,
       'Parquet / JSON / CSV files' AS ingesta, 'JSON documents' AS almacenamiento, * FROM (
SELECT 'ventas.csv' AS archivo, 'CSV' AS formato, COUNT(*) AS registros FROM raw_sales
UNION ALL SELECT 'clientes.csv', 'CSV', COUNT(*) FROM raw_customers
UNION ALL SELECT 'catalogo_juegos.json', 'JSON', COUNT(*) FROM raw_catalog
UNION ALL SELECT 'resenas.json', 'JSON', COUNT(*) FROM raw_reviews
UNION ALL SELECT 'logs_tienda.txt', 'TXT', COUNT(*) FROM events
UNION ALL SELECT 'inventario.xml', 'XML', COUNT(*) FROM raw_inventory)""")

SQL["output_inventory"] = w(f"""
SELECT 'ventas_procesadas' AS coleccion, COUNT(*) AS documentos FROM wide
UNION ALL SELECT 'analisis_juegos', COUNT(*) FROM kpi1
UNION ALL SELECT 'analisis_categorias', COUNT(DISTINCT categoria) FROM wide
UNION ALL SELECT 'analisis_plataformas', COUNT(*) FROM kpi3
UNION ALL SELECT 'reportes_mensuales', COUNT(*) FROM (SELECT DISTINCT anio, mes FROM wide WHERE {MONTHS})
UNION ALL SELECT 'perfil_clientes', COUNT(*) FROM kpi5
UNION ALL SELECT 'alertas_inventario', COUNT(*) FROM kpi7""")

SQL["read_back_platforms"] = w(f"""
SELECT plataforma, num_ventas, {pct1('num_ventas', 'SUM(num_ventas) OVER ()')} AS cuota_mercado_pct FROM kpi3""")
SQL["read_back_games"] = SQL["kpi_top_products"]
SQL["read_back_months"] = w(f"SELECT anio, mes, ingresos_mes FROM kpi4 WHERE {MONTHS}")
SQL["read_back_alerts"] = SQL["kpi_low_stock"]
SQL["read_back_customers"] = SQL["kpi_top_customers"].replace("MAX(fecha) AS ultima_compra", "CAST(MAX(fecha) AS VARCHAR) AS ultima_compra")

SQL["sql_views"] = w("""
SELECT plataforma, COUNT(venta_id) AS ventas, COUNT(DISTINCT cliente_id) AS clientes,
       (SELECT COUNT(*) FROM inventory i WHERE i.plataforma = x.plataforma AND i.stock > i.umbral) AS juegos_en_stock
FROM wide x GROUP BY plataforma""")

SQL["kpi_order"] = w(f"""
SELECT 'plataformas' AS kpi, ROW_NUMBER() OVER (ORDER BY ingresos_total DESC, plataforma) AS orden, plataforma AS inicio FROM kpi3
UNION ALL SELECT 'categorias', ROW_NUMBER() OVER (ORDER BY ingresos_total DESC, categoria), categoria FROM (
  SELECT categoria, {money_sum('total')} AS ingresos_total FROM wide WHERE categoria IS NOT NULL GROUP BY categoria)
UNION ALL SELECT 'ventas_mensuales', ROW_NUMBER() OVER (ORDER BY anio NULLS FIRST, mes NULLS FIRST),
       coalesce(CAST(anio AS VARCHAR), '') || '|' || coalesce(CAST(mes AS VARCHAR), '') FROM kpi4
UNION ALL SELECT 'pago_membresia', ROW_NUMBER() OVER (ORDER BY nivel_membresia, n DESC, metodo_pago), nivel_membresia || '|' || metodo_pago FROM (
  SELECT nivel_membresia, metodo_pago, COUNT(*) AS n FROM wide WHERE nivel_membresia IS NOT NULL GROUP BY ALL)
UNION ALL SELECT 'top_clientes', ROW_NUMBER() OVER (ORDER BY gasto_total DESC, cliente_id), cliente_id FROM kpi5""")

SQL["xml_inventory"] = w("SELECT juego_id, titulo_inv, plataforma, stock, precio_inv, umbral FROM raw_inventory")

SQL["json_catalog"] = w(f"SELECT {text_columns(GAME_COLS)}, FALSE AS corrupto FROM raw_catalog")
SQL["json_array_catalog"] = w(f"SELECT {text_columns(GAME_COLS)} FROM raw_catalog")
SQL["log_from_text"] = SQL["log_activity"]
SQL["csv_folder"] = SQL["log_activity"]

SQL["csv_roundtrip"] = w("SELECT * FROM raw_customers")

SQL["parquet_roundtrip"] = w(f"SELECT {text_columns(WIDE_COLS)} FROM wide")

SQL["encode_messages"] = w("""
SELECT venta_id AS key, event_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_timestamp, venta_id, cliente_id, juego_id,
       plataforma_raw AS plataforma, metodo_pago, vendedor, precio, cantidad, total, CAST(NULL AS VARCHAR) AS cliente_nombre,
       CAST(NULL AS VARCHAR) AS nivel_membresia, CAST(NULL AS VARCHAR) AS distrito, riesgo_fraude, venta_riesgosa FROM sev""")

SQL["stream_by_platform"] = w(f"""
SELECT batch_id, plataforma, COUNT(*) AS total_ventas, {money_sum('total')} AS ingresos,
       {avg2('total')} AS ticket_promedio,
       CAST(SUM(CAST(venta_riesgosa AS INTEGER)) AS BIGINT) AS ventas_riesgo
FROM senr GROUP BY batch_id, plataforma""")

SQL["stream_by_payment"] = w(f"""
SELECT batch_id, metodo_pago, COUNT(*) AS total_transacciones, {money_sum('total')} AS monto_total,
       {avg2('riesgo_fraude')} AS riesgo_promedio
FROM senr GROUP BY batch_id, metodo_pago""")

SQL["stream_alerts"] = w("""
SELECT event_id, venta_id, cliente_nombre, plataforma, metodo_pago, total, riesgo_fraude, event_timestamp, batch_id
FROM senr WHERE COALESCE(venta_riesgosa, FALSE) OR riesgo_fraude >= 0.75""")

SQL["stream_enriched"] = w("SELECT * FROM senr")

SQL["stream_rejects"] = w("""
SELECT venta_id AS message_key, n % 3 AS batch_id,
       '{"event_id":"' || event_id || '","event_type":"' || event_type || '","event_timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
       '","venta_id":"' || venta_id || '","cliente_id":"' || cliente_id || '","juego_id":"' || juego_id || '","plataforma":"' || plataforma_raw ||
       '","metodo_pago":"' || metodo_pago || '","vendedor":"' || vendedor || '","precio":' || CAST(precio AS VARCHAR) || ',"cantidad":' ||
       CASE WHEN n % 10 = 5 THEN '"n' || CAST(cantidad AS VARCHAR) || '"' ELSE CAST(cantidad AS VARCHAR) END || ',"total":' || CAST(total AS VARCHAR) ||
       ',"riesgo_fraude":' || CAST(riesgo_fraude AS VARCHAR) || CASE WHEN n % 10 = 5 THEN '}' ELSE '' END AS message_value
FROM sev WHERE damaged""")

# --- the live jobs. Deliveries: by ten days of the month, some events one or two later.
LIVE = f"""
dl AS (
  SELECT event_id, event_timestamp AS t, {platform('plataforma_raw')} AS plataforma, total, venta_riesgosa,
         least(2, (day(ts) - 1) // 10 + CASE WHEN n % 11 = 5 THEN 2 WHEN n % 7 = 3 THEN 1 ELSE 0 END) AS k
  FROM sev WHERE NOT damaged),
wm AS (SELECT k, (SELECT max(t) FROM dl WHERE dl.k < b.k) - INTERVAL 2 DAY AS before, (SELECT max(t) FROM dl WHERE dl.k <= b.k) - INTERVAL 2 DAY AS after
       FROM (SELECT DISTINCT k FROM dl) b),"""


def more(body: str) -> str:
    """``body`` begins with further common tables."""
    return w("").rstrip() + "," + body


def live_windows(length: int) -> str:
    """Windows of ``length`` days that begin each day (one day: tumbling)."""
    return LIVE + f"""
wd AS (SELECT dl.*, date_trunc('day', t) - to_days(CAST(i AS INTEGER)) AS ini, date_trunc('day', t) - to_days(CAST(i AS INTEGER)) + INTERVAL {length} DAY AS fin
       FROM dl, range({length}) x(i)),
ok AS (SELECT wd.* FROM wd JOIN wm USING (k) WHERE wm.before IS NULL OR wd.fin > wm.before)"""


def closed(length: int) -> str:
    return more(live_windows(length) + f"""
SELECT ini AS ventana_inicio, plataforma, COUNT(*) AS ventas, {money_sum('total')} AS ingresos, {avg2('total')} AS ticket_promedio,
       CAST(SUM(CAST(COALESCE(venta_riesgosa, FALSE) AS INTEGER)) AS BIGINT) AS ventas_riesgo,
       (SELECT min(wm.k) FROM wm WHERE wm.after >= ok.fin) AS batch_id
FROM ok WHERE fin <= (SELECT max(wm.after) FROM wm) GROUP BY ini, fin, plataforma""")


SQL["live_daily_sales"] = closed(1)
SQL["live_sliding_sales"] = closed(7)
SQL["live_late_events"] = more(live_windows(1) + """
SELECT event_id, plataforma, ini AS ventana_inicio, k AS batch_id FROM wd JOIN wm USING (k) WHERE wd.fin <= wm.before""")

SQL["live_stock_alerts"] = more(f"""
mv AS (
  SELECT e.juego_id, e.plataforma, e.event_id, e.event_timestamp, i.stock AS inicio, i.umbral,
         e.cantidad * CASE e.event_type WHEN 'venta_completada' THEN 1 ELSE -1 END AS u, e.batch_id
  FROM senr e JOIN (SELECT juego_id, plataforma, SUM(stock) AS stock, MAX(umbral) AS umbral FROM inventory GROUP BY ALL) i
    ON i.juego_id = e.juego_id AND i.plataforma = e.plataforma
  WHERE e.event_type IN ('venta_completada', 'venta_cancelada')),
run AS (SELECT *, inicio - SUM(u) OVER (PARTITION BY juego_id, plataforma ORDER BY batch_id, event_timestamp, event_id) AS queda FROM mv)
SELECT juego_id, plataforma, event_id, event_timestamp, CAST(queda AS BIGINT) AS stock, umbral FROM run
WHERE queda <= umbral AND queda + u > umbral""")

SQL["order_net_revenue"] = more(f"""
od AS (
  SELECT o_orderkey AS k, {lst(STREAM_PLATFORMS)}[o_orderkey % {len(STREAM_PLATFORMS)} + 1] AS p, o_totalprice AS total,
         o_orderkey % 10 < 7 AS pagada, o_orderkey % 4 = 0 AS cancelada FROM orders)
SELECT {platform('p')} AS plataforma, COUNT(*) AS creadas, COUNT(*) FILTER (pagada) AS pagadas, COUNT(*) FILTER (cancelada) AS canceladas,
       COUNT(*) FILTER (NOT pagada AND NOT cancelada) AS sin_respuesta,
       COALESCE({money_sum('CASE WHEN pagada AND NOT cancelada THEN total END')}, 0) AS ingresos_netos
FROM od GROUP BY ALL""")

SQL["customer_as_of_event"] = more("""
cd AS (
  SELECT c.cliente_id, d.n, d.t, CASE WHEN d.n > 0 AND c.k % 3 = 0 THEN 'Plus' ELSE c.nivel_membresia END AS nivel_membresia,
         CASE WHEN d.n > 1 AND c.k % 4 = 0 THEN 'Lima' ELSE c.distrito END AS distrito
  FROM (SELECT *, CAST(substr(cliente_id, 2) AS BIGINT) AS k FROM customers) c,
       (VALUES (0, TIMESTAMP '2024-01-01'), (1, TIMESTAMP '2024-01-11'), (2, TIMESTAMP '2024-01-21')) d(n, t)
  WHERE d.n > 0 OR c.k % 7 <> 0)
SELECT e.event_id, e.cliente_id, e.event_timestamp,
       (SELECT max_by(cd.nivel_membresia, cd.t) FROM cd WHERE cd.cliente_id = e.cliente_id AND cd.t <= e.event_timestamp) AS nivel_membresia,
       (SELECT max_by(cd.distrito, cd.t) FROM cd WHERE cd.cliente_id = e.cliente_id AND cd.t <= e.event_timestamp) AS distrito
FROM sev e WHERE NOT e.damaged""")

SQL["stream_csv_customers"] = w("SELECT event_id, cliente_id, cliente_nombre, nivel_membresia, distrito, batch_id FROM senr")

# Deliveries of the sales: 1999 and before or no date, 2000 on, moved sales, nothing new but one customer's membership.
DELIVERED = f"""
SELECT *, CASE WHEN COALESCE(try_strptime(fecha, '%Y-%m-%d') < DATE '2000-01-01', TRUE) THEN 0 ELSE 1 END AS entrega FROM ({CTES["raw_sales"]})
UNION ALL
SELECT * REPLACE (strftime(try_strptime(fecha, '%Y-%m-%d') + INTERVAL 40 DAY, '%Y-%m-%d') AS fecha), 2 AS entrega
FROM ({CTES["raw_sales"]}) WHERE regexp_matches(fecha, '^2000-0[123]-') AND venta_id LIKE '%-3'"""

SQL["incremental_wide"] = with_ctes(f"SELECT {text_columns(WIDE_COLS)} FROM wide", {"raw_sales": f"SELECT * EXCLUDE (entrega) FROM ({DELIVERED})"})


def sales_after(k: int) -> str:
    """The clean sales after delivery ``k``, from all that arrived until then."""
    names = ("sales_n", "sales_c", "sales_d", "sales")
    parts = [f"raw_sales AS (SELECT * EXCLUDE (entrega) FROM delivered WHERE entrega <= {k})", *[f"{n} AS ({CTES[n]})" for n in names]]
    return f"(WITH {', '.join(parts)} SELECT * FROM sales)"


def months_of(k: int) -> str:
    """Months of sales that delivery ``k`` added, or whose row it replaced."""
    if k == 0:
        return f"SELECT DISTINCT 0 AS entrega, COALESCE(anio * 100 + mes, 0) AS mes FROM {sales_after(0)}"
    return f"""
SELECT DISTINCT {k} AS entrega, unnest(CASE WHEN o.venta_id IS NULL THEN [COALESCE(n.anio * 100 + n.mes, 0)]
       ELSE [COALESCE(n.anio * 100 + n.mes, 0), COALESCE(o.anio * 100 + o.mes, 0)] END) AS mes
FROM {sales_after(k)} n LEFT JOIN {sales_after(k - 1)} o ON o.venta_id = n.venta_id
WHERE o.venta_id IS NULL OR {" OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in RAW_SALES_COLS)}"""


SQL["incremental_months"] = f"""WITH delivered AS ({DELIVERED}),
m AS ({" UNION ".join(f"SELECT * FROM ({months_of(k)})" for k in range(3))}
  UNION SELECT DISTINCT 3, COALESCE(anio * 100 + mes, 0) FROM {sales_after(2)} WHERE cliente_id = 'C7')
SELECT CAST(entrega AS BIGINT) AS entrega, CAST(mes AS INTEGER) AS mes FROM m"""

# Periods of a sale: the whole time, its year, its month.
PERIODS = """
sp AS (SELECT *, unnest(CASE WHEN anio IS NULL THEN ['todo'] ELSE ['todo', CAST(anio AS VARCHAR), printf('%d-%02d', anio, mes)] END) AS periodo FROM sales)"""

SQL["distinct_by_period"] = more(PERIODS + """
SELECT periodo, COUNT(DISTINCT cliente_id) AS clientes, COUNT(DISTINCT juego_id) AS juegos, TRUE AS clientes_en_cota, TRUE AS juegos_en_cota
FROM sp GROUP BY ALL""")

SQL["quantiles_by_period"] = more(PERIODS + """
SELECT periodo, 'precio' AS columna, CAST(p AS DOUBLE) AS rango, COUNT(precio) AS filas, TRUE AS en_cota
FROM sp, (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) v(p) GROUP BY ALL HAVING COUNT(precio) > 0
UNION ALL
SELECT periodo, 'cantidad', CAST(p AS DOUBLE), COUNT(cantidad), TRUE
FROM sp, (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) v(p) GROUP BY ALL HAVING COUNT(cantidad) > 0""")

SQL["sales_drift"] = more("""
va AS (
  SELECT 'antes' AS e, precio, cantidad FROM sales WHERE anio < 2000
  UNION ALL SELECT 'desde_2000', precio, cantidad FROM sales WHERE anio >= 2000
  UNION ALL SELECT 'encarecido', precio * 1.5, cantidad FROM sales WHERE anio >= 2000),
vl AS (SELECT e, 'precio' AS columna, precio AS v FROM va UNION ALL SELECT e, 'cantidad', cantidad FROM va),
cdf AS (SELECT e, columna, v, CUME_DIST() OVER (PARTITION BY e, columna ORDER BY v) AS f FROM vl WHERE v IS NOT NULL),
pts AS (SELECT DISTINCT o.e, o.columna, x.v FROM (SELECT DISTINCT e, columna FROM cdf WHERE e <> 'antes') o JOIN cdf x ON x.columna = o.columna AND x.e IN ('antes', o.e)),
one AS (SELECT DISTINCT e, columna, v, f FROM cdf),
fa AS (SELECT p.e, p.columna, p.v, COALESCE(a.f, 0) AS fa FROM pts p ASOF LEFT JOIN (SELECT * FROM one WHERE e = 'antes') a ON a.columna = p.columna AND a.v <= p.v),
fb AS (SELECT p.*, COALESCE(b.f, 0) AS fb FROM fa p ASOF LEFT JOIN one b ON b.columna = p.columna AND b.e = p.e AND b.v <= p.v)
SELECT e AS entrega, columna, MAX(ABS(fa - fb)) > 0.1 AS deriva FROM fb GROUP BY ALL""")

SQL["top_games_by_period"] = more(PERIODS + """,
gs AS (SELECT periodo, juego_id, CAST(SUM(cantidad) AS BIGINT) AS unidades FROM sp WHERE length(periodo) = 4 GROUP BY ALL HAVING SUM(cantidad) > 0)
SELECT periodo, ROW_NUMBER() OVER (PARTITION BY periodo ORDER BY unidades DESC, juego_id) AS puesto, juego_id, unidades
FROM gs QUALIFY puesto <= 10""")
