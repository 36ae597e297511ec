"""Inputs of the reports, derived from the driver tables, once for Spark and once as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_RAW_TRIPS = """
select {day} as {q}Fecha{q}, event_type as {q}Ruta{q},
       case when event_id%13=0 then 'x' else cast(user_id as {text}) end as {q}Económico planificado{q},
       case when event_id%23=0 then '-' else cast(1000+user_id as {text}) end as {q}Vehiculo real{q},
       concat('C', cast(user_id%100 as {text})) as {q}Conductor{q},
       case when event_id%7=0 then '24:00:00' else {clock} end as {q}Llegada al punto{q},
       case when event_id%17=0 then '-' else {planned} end as {q}Partida Planeada{q},
       case when st=1 then {clock} else '-' end as {q}Partida Real{q},
       concat(case when d<0 then '-' else '' end, mmss) as {q}Diff Partida{q},
       case when event_id%5=0 then '-' else concat('-', mmss) end as {q}HE{q},
       {planned} as {q}Llegada Planeada{q},
       case when event_id%19=0 then '-' else {clock} end as {q}Llegada Real{q},
       concat(' -', mmss) as {q}Diff llegada{q},
       mmss as {q}Tiempo Viaje{q},
       concat(cast(event_id%40 as {text}), '.5') as {q}KM Realizado{q},
       case when event_id%31=0 then '-' else concat(cast(event_id%60 as {text}), '.25') end as {q}Vel. promedio Km{q},
       mmss as {q}Tiemp.Punto{q},
       concat(cast(event_id%90 as {text}), '.7') as {q}Pasajero{q},
       case when event_id%6=0 then 'nd' else '1.5' end as {q}I.P.K{q},
       cast(st as {text}) as {q}Status del Viaje{q},
       case when st=1 then 'Realizado' else 'Cancelado' end as {q}Desc. Status del Viaje{q},
       'No' as {q}Viaje Editado{q},
       cast(event_id%20 as {text}) as {q}Jornada{q},
       concat('E', cast(event_id%3 as {text})) as {q}Empresa{q}
from (select *, concat('00:', lpad(cast(abs(d) {div} 60 as {text}),2,'0'), ':',
                       lpad(cast(abs(d)%60 as {text}),2,'0')) as mmss
      from (select event_id, event_type, user_id, ts, cast(event_id*37%601 as int)-300 as d,
                   case when event_id%11=0 then 2 else 1 end as st
            from {events}) b) e
{copies}
"""

_SPARK = {
    "q": "`", "text": "string", "div": "div",
    "clock": "date_format(ts,'HH:mm:ss')",
    "planned": "date_format(timestampadd(SECOND,d,ts),'HH:mm:ss')",
    "copies": "lateral view explode(sequence(1, case when event_id%50=0 then 2 else 1 end)) c as copy",
}
_DUCK = {
    "q": '"', "text": "varchar", "div": "//", "events": "events",
    "clock": "strftime(ts,'%H:%M:%S')",
    "planned": "strftime(ts + to_seconds(d),'%H:%M:%S')",
    "copies": "cross join lateral (select unnest(range(case when event_id%50=0 then 2 else 1 end)) as copy) c",
}
_SPARK_DAY = "date_format(ts,'dd/MM/yyyy')"
_DUCK_DAY = "strftime(ts,'%d/%m/%Y')"


def _sometimes_bad(day: str) -> str:
    return f"case when event_id%97=0 then '-' else {day} end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_out(rows: DataFrame) -> DataFrame:
    """The rows of a Parquet table in even partitions, by their place in their file: a table of few row groups keeps few cores busy."""
    return rows.select("*", F.col("_metadata.row_index").alias("_row")).repartition("_row").drop("_row")


def raw_trips(spark: SparkSession, sf_dir: str, bad_days: bool = True) -> DataFrame:
    """Raw trip report from ``events``: some rows twice, some unreadable values."""
    day = _sometimes_bad(_SPARK_DAY) if bad_days else _SPARK_DAY
    sql = _RAW_TRIPS.format(**_SPARK, day=day, events="{events}")
    return spark.sql(sql, events=dealt_out(table(spark, sf_dir, "events")))


def raw_trips_sql(bad_days: bool = True) -> str:
    day = _sometimes_bad(_DUCK_DAY) if bad_days else _DUCK_DAY
    return _RAW_TRIPS.format(**_DUCK, day=day)


_CAN = """
select l_orderkey, l_linenumber, {when} as "Fecha", 'E1' as "Empresa",
       concat(b,'  RPM = ',rpm,' rpm  Velocidad = ',v,'.5 km/h  Tanque 1 y 2 = ',v,'.1 y 7.9 kPa',
              case l_linenumber
                when 1 then '  Temperatura Baterias = 30 °C, SOC = 80 %'
                when 2 then '  Nivel = bajo  Nivel = alto  sin valor'
                when 3 then '  Temperatura Baterias = 20.5 min, 31.5 max'
                when 4 then '  Condicion de Frenos: Del_D = 1.1, Del_I = 2.2, Tra_D1 = 3.3, Tra_I1 = 4.4, Tra_D2 = 5.5, Tra_I2 = 6.6'
                when 5 then '  ALARM Steering = ok, Brake = low'
                when 6 then '  Par = 9 Nm'
                when 7 then case when l_orderkey%3=0 then '  Par = 8 lb' else '' end else '' end,
              case when l_orderkey%4=0 then '  Presion = alta' else '  Presion = 5 bar' end,
              case when l_orderkey%9=0 then '  Caudal = alto' else concat('  Caudal = ',v,'.5 lpm') end,
              case when b='Volvo' then '  Solo = 4 V' else '' end,
              '  ALARM Motor = ok, Battery = ok, Air = low  Horas = ',rpm,'.5, Total Fuel usado = 900.1') as "Can Data"
from (select l_orderkey, l_linenumber, l_shipdate,
             case l_suppkey%8 when 0 then 'Volvo' when 1 then 'Yutong' when 2 then 'BYD' when 3 then 'Mercedes'
                              when 4 then 'ADennis' when 5 then 'List' when 6 then 'Erro' else 'Otra Marca' end as b,
             cast(cast(l_quantity as int)*50 as {text}) as rpm,
             cast(cast(round(l_discount*100) as int) as {text}) as v
      from {lineitem}) t
"""


def can_rows(spark: SparkSession, sf_dir: str, by: Column | None = None) -> DataFrame:
    """Telemetry text from ``lineitem``; (l_orderkey, l_linenumber) is a label, not a key. Rows of one value of ``by`` come from one
    task: they are shuffled before the texts are made."""
    lineitem = table(spark, sf_dir, "lineitem")
    lineitem = lineitem if by is None else lineitem.repartition(by)
    sql = _CAN.format(text="string", when="date_format(l_shipdate,'dd/MM/yyyy HH:mm:ss')", lineitem="{lineitem}")
    return spark.sql(sql.replace('"', "`"), lineitem=lineitem)


def can_rows_sql() -> str:
    return _CAN.format(text="varchar", when="strftime(l_shipdate,'%d/%m/%Y %H:%M:%S')", lineitem="lineitem")


_FLEET = """
select '20260701' as "Date", case when c_custkey%2=0 then 'Matutino' else 'Vespertino' end as "Turno",
       c_mktsegment as "Ruta", case when c_custkey%9=0 then 'x' else concat(cast(c_nationkey as {text}), '.0') end as "Jornada",
       cast(c_custkey as {text}) as "Económico", c_name as "Empresa Programado", c_name as "Empresa Real"
from {customer}
"""


def fleet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = _FLEET.format(text="string", customer="{customer}").replace('"', "`")
    return spark.sql(sql, customer=table(spark, sf_dir, "customer"))


def fleet_rows_sql() -> str:
    return _FLEET.format(text="varchar", customer="customer")


def altered_lineitem(lineitem: DataFrame) -> DataFrame:
    """A copy in which some rows are changed, some missing and some doubled."""
    k = F.col("l_orderkey")
    return (
        lineitem.filter(k % 101 != 0)
        .withColumn("l_quantity", F.when(k % 103 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(k % 107 == 0, 2).otherwise(1))))
        .drop("copy")
    )


def altered_lineitem_sql() -> str:
    return """
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
       case when l_orderkey%103=0 then l_quantity+1 else l_quantity end as l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
from lineitem cross join lateral (select unnest(range(case when l_orderkey%107=0 then 2 else 1 end)) as copy) c
where l_orderkey%101<>0
"""


_NOTES = """
select event_id, event_type,
       case when event_id%3=0 then concat('línea ',event_id,{lf},'"',props,'";',{lf},{lf},'fin')
            when event_id%3=1 then concat(event_type,'"',user_id,'"') else concat({lf},event_type,';') end as note
from {events}
"""


def event_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text per event, with line breaks, quotes and separators."""
    return spark.sql(_NOTES.format(lf="chr(10)", events="{events}"), events=table(spark, sf_dir, "events"))


def event_notes_sql() -> str:
    return _NOTES.format(lf="chr(10)", events="events")
