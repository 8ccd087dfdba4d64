"""Fixed schemas of the raw entities (no inference anywhere)."""

from pyspark.sql import types as T

S, D, I, L, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CORRUPT = "_corrupt_record"

SALES = _struct(
    ("venta_id", S), ("fecha", S), ("cliente_id", S), ("juego_id", S),
    ("plataforma", S), ("precio", D), ("cantidad", I), ("metodo_pago", S),
    ("vendedor", S),
)

CUSTOMERS = _struct(
    ("cliente_id", S), ("nombre", S), ("edad", I), ("genero", S),
    ("distrito", S), ("nivel_membresia", S),
)

CATALOG = _struct(
    ("juego_id", S), ("titulo", S), ("categoria", S),
    ("plataformas", T.ArrayType(S)), ("precio_base", D), ("desarrollador", S),
    ("publicador", S), ("anio_lanzamiento", I), ("pegi", I), ("descripcion", S),
    ("tags", T.ArrayType(S)),
)

REVIEWS = _struct(
    ("resena_id", S), ("juego_id", S), ("puntuacion", D), ("util_votos", I),
)

INVENTORY = _struct(
    ("juego_id", S), ("titulo_inv", S), ("plataforma", S), ("stock", I),
    ("precio_inv", D), ("umbral", I),
)

# XML reader schema for <juego id=..><titulo/><plataformas><plataforma nombre=..>
INVENTORY_XML = T.StructType([
    T.StructField("_id", S),
    T.StructField("titulo", S),
    T.StructField("plataformas", T.StructType([
        T.StructField("plataforma", T.ArrayType(T.StructType([
            T.StructField("_nombre", S),
            T.StructField("stock", I),
            T.StructField("precio", D),
            T.StructField("umbral_reposicion", I),
        ]))),
    ])),
])

# Fixed contract: the sale event carried by the message stream (17 fields, all nullable).
EVENT = _struct(
    ("event_id", S), ("event_type", S), ("event_timestamp", S),
    ("venta_id", S), ("cliente_id", S), ("juego_id", S),
    ("plataforma", S), ("metodo_pago", S), ("vendedor", S),
    ("precio", D), ("cantidad", I), ("total", D),
    ("cliente_nombre", S), ("nivel_membresia", S), ("distrito", S),
    ("riesgo_fraude", D), ("venta_riesgosa", B),
)

# Raw message as delivered by a broker: key, value, broker timestamp.
MESSAGE = T.StructType([
    T.StructField("key", S), T.StructField("value", S),
    T.StructField("timestamp", T.TimestampType()),
])


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, S, True)])
