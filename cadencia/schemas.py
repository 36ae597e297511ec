"""Table contracts and the fixed values of the input reports."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    header: str  # header in the raw report
    name: str  # column in the trip table
    kind: str  # day | clock | whole | real | text


# Headers of the raw trip report and the trip-table columns they become.
TRIP_FIELDS = (
    Field("Fecha", "FECHA", "day"),
    Field("Ruta", "RUTA", "text"),
    Field("Económico planificado", "ECONOMICO_PLANIFICADO", "whole"),
    Field("Vehiculo real", "VEHICULO_REAL", "whole"),
    Field("Conductor", "CONDUCTOR", "text"),
    Field("Llegada al punto", "LLEGADA_AL_PUNTO", "clock"),
    Field("Partida Planeada", "PARTIDA_PLANEADA", "clock"),
    Field("Partida Real", "PARTIDA_REAL", "clock"),
    Field("Diff Partida", "DIFF_PARTIDA", "text"),
    Field("HE", "HE", "text"),
    Field("Llegada Planeada", "LLEGADA_PLANEADA", "clock"),
    Field("Llegada Real", "LLEGADA_REAL", "clock"),
    Field("Diff llegada", "DIFF_LLEGADA", "text"),
    Field("Tiempo Viaje", "TIEMPO_VIAJE", "clock"),
    Field("KM Realizado", "KM_REALIZADO", "real"),
    Field("Vel. promedio Km", "VEL_PROMEDIO_KM", "real"),
    Field("Tiemp.Punto", "TIEMPPUNTO", "clock"),
    Field("Pasajero", "PASAJERO", "whole"),
    Field("I.P.K", "IPK", "real"),
    Field("Status del Viaje", "STATUS_DEL_VIAJE", "whole"),
    Field("Desc. Status del Viaje", "DESC_STATUS_DEL_VIAJE", "text"),
    Field("Viaje Editado", "VIAJE_EDITADO", "text"),
    Field("Jornada", "POSICION", "whole"),
    Field("Empresa", "EMPRESA", "text"),
)

PARTITION_COLUMN = "service_week"


def _trip_type(kind: str) -> T.DataType:
    if kind == "clock":
        return T.TimeType()
    return {
        "day": T.TimestampNTZType(),
        "whole": T.LongType(),
        "real": T.DoubleType(),
        "text": T.StringType(),
    }[kind]


def trip_schema() -> T.StructType:
    return T.StructType([T.StructField(f.name, _trip_type(f.kind)) for f in TRIP_FIELDS])


HEADWAY_SCHEMA = T.StructType(
    [
        T.StructField("FECHA", T.TimestampNTZType()),
        T.StructField("RUTA", T.StringType()),
        T.StructField("ECONOMICO", T.DoubleType()),
        T.StructField("PARTIDA_REAL", T.TimestampNTZType()),
        T.StructField("ESTADO", T.StringType()),
        T.StructField("DIFF_PARTIDA", T.DoubleType()),
        T.StructField("TIMESTAMP_SALIDA", T.TimestampNTZType()),
        T.StructField("SALIDA_SIGUIENTE", T.TimestampNTZType()),
        T.StructField("INTERVALO", T.StringType()),
        T.StructField("INTERVALO_MINUTOS", T.DoubleType()),
        T.StructField("DIA_DE_LA_SEMANA", T.LongType()),
        T.StructField("TURNO", T.StringType()),
        T.StructField("FRANJA_HORARIA", T.LongType()),
    ]
)

GAP_SCHEMA = T.StructType(
    [
        T.StructField("FECHA", T.DateType()),
        T.StructField("RUTA", T.StringType()),
        T.StructField("HORA", T.LongType()),
        T.StructField("INTERVALO_SEC", T.DoubleType()),
    ]
)

# Headers of the fleet snapshot and their table names.
FLEET_COLUMNS = {
    "Date": "date",
    "Turno": "turno",
    "Ruta": "ruta",
    "Jornada": "jornada",
    "Económico": "economico",
    "Empresa Programado": "empresa_programado",
    "Empresa Real": "empresa_real",
}


class Brand(NamedTuple):
    name: str
    prefix: str  # telemetry rows of the brand start with this text
    drop: tuple[str, ...]  # columns left out of the brand's output, named as after unit stripping


# Brands of the telemetry report.
BRANDS = (
    Brand(
        "Volvo",
        "Volvo",
        (
            "Empresa",
            "Marca",
            "Luz Check Engine",
            "Luz Precaucion",
            "Luz Alerta",
            "Switch Acelerador",
            "Torque Actual (%)",
            "Torque Solicitado (%)",
            "Temperatura Exterior (°C)",
        ),
    ),
    Brand(
        "Yutong",
        "Yutong",
        ("Empresa", "Marca", "Switch Acelerador", "Torque Actual (%)", "Torque Solicitado (%)"),
    ),
    Brand("BYD", "BYD", ("Empresa", "Marca")),
    Brand("Mercedes Benz", "Merc", ("Empresa", "Marca")),
    Brand("Alexander Dennis", "ADennis", ("Empresa", "Marca")),
    Brand("Scania", "Scania", ("Empresa", "Marca")),
)
