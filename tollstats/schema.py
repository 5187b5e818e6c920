"""Tables of the toll model: raw monthly record, station dimension, traffic fact."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class RawColumn(NamedTuple):
    raw: str
    name: str
    kind: str  # bigint | int | double


class Tables(NamedTuple):
    """The two tables every report works on."""

    peaje: DataFrame
    flujo_peaje: DataFrame


# Column names of the raw record and of the two tables.
STATION_COLUMNS = [
    ("NOMBRE_PEAJE", "nombre_peaje"),
    ("DEPARTAMENTO", "departamento"),
    ("ADMINIST", "administracion"),
]
MEASURE_COLUMNS = [
    RawColumn("ANIO", "anio", "int"),
    RawColumn("MES", "mes", "int"),
    RawColumn("VEH_LIGEROS_TAR_DIF", "veh_ligeros_tar_dif", "bigint"),
    RawColumn("VEH_LIGEROS_AUTOMOVILES", "veh_ligeros_automoviles", "bigint"),
    RawColumn("VEH_LIGEROS_TOTAL", "veh_ligeros_total", "bigint"),
    RawColumn("VEH_LIGEROS_IMD", "veh_ligeros_imd", "double"),
    RawColumn("VEH_PESADOS_TAR_DIF", "veh_pesados_tar_dif", "bigint"),
    RawColumn("VEH_PESADOS__2E", "veh_pesados_2e", "bigint"),
    RawColumn("VEH_PESADOS_3E", "veh_pesados_3e", "bigint"),
    RawColumn("VEH_PESADOS_4E", "veh_pesados_4e", "bigint"),
    RawColumn("VEH_PESADOS_5E", "veh_pesados_5e", "bigint"),
    RawColumn("VEH_PESADOS_6E", "veh_pesados_6e", "bigint"),
    RawColumn("VEH_PESADOS_7E", "veh_pesados_7e", "bigint"),
    RawColumn("VEH_PESADOS_TOTAL", "veh_pesados_total", "bigint"),
    RawColumn("VEH_PESADOS_IMD", "veh_pesados_imd", "double"),
    RawColumn("VEH_TOTAL", "veh_total", "bigint"),
    RawColumn("VEH_IMD", "veh_imd", "double"),
]
ID_COLUMN = RawColumn("ID", "id_flujo", "bigint")

STATION_KEY = [name for _, name in STATION_COLUMNS]
RAW_NAMES = [ID_COLUMN.raw, *(raw for raw, _ in STATION_COLUMNS), *(c.raw for c in MEASURE_COLUMNS)]
FLUJO_NAMES = [ID_COLUMN.name, "id_peaje", *(c.name for c in MEASURE_COLUMNS)]

# Of a scanned file: the whole line where it is no record.
MALFORMED = "_malformed"

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_NAMES])

PEAJE_SCHEMA = T.StructType(
    [T.StructField("id_peaje", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in STATION_KEY]
)

_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType()}

FLUJO_SCHEMA = T.StructType(
    [T.StructField("id_flujo", T.LongType()), T.StructField("id_peaje", T.LongType())]
    + [T.StructField(c.name, _TYPES[c.kind]) for c in MEASURE_COLUMNS]
)

# Active stations as bitmaps of their ids, by year and administration.
ACTIVITY_KEYS = ["anio", "administracion"]
ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField("anio", T.IntegerType()),
        T.StructField("administracion", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bitmap", T.BinaryType()),
    ]
)
