"""The same results in DuckDB SQL, written without the engine's shortcuts (plain windows, plain joins)."""

from __future__ import annotations

from checks.views import altered_lineitem_sql, can_rows_sql, event_notes_sql, fleet_rows_sql, raw_trips_sql

_CLOCK = r"'^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$'"


def _seconds(col: str) -> str:
    part = [f"cast(split_part({col},':',{i}) as int)" for i in (1, 2, 3)]
    return (
        f"case when regexp_matches({col}, {_CLOCK}) "
        f"then {part[0]}*3600 + {part[1]}*60 + {part[2]} end"
    )


def _clock_text(seconds: str) -> str:
    return f"strftime(timestamp '2000-01-01' + to_seconds({seconds}), '%H:%M:%S')"


def _clock(col: str) -> str:
    return _clock_text(f"({_seconds(col)})")


def _day(col: str) -> str:
    return f"cast(try_strptime({col}, '%d/%m/%Y') as date)"


def _whole(col: str) -> str:
    return f"coalesce(cast(trunc(try_cast({col} as double)) as bigint), 0)"


def _real(col: str) -> str:
    return f"coalesce(try_cast({col} as double), 0.0::double)"


def _stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def _signed(col: str, dash_is_early: bool) -> str:
    part = [
        f"coalesce(try_cast(regexp_extract({col}, '(\\d+):(\\d+):(\\d+)', {i}) as bigint), 0)"
        for i in (1, 2, 3)
    ]
    minutes = f"({part[0]}*60 + {part[1]} + {part[2]}/60.0::double)"
    dash = f"coalesce(starts_with({col}, '-'), false)"
    positive = dash if dash_is_early else f"not {dash}"
    return f"(case when {positive} then {minutes} else -{minutes} end + 0.0::double)"


def _typed(bad_days: bool = True) -> str:
    return f"""
select {_stamp(_day('"Fecha"'))} as "FECHA", "Ruta" as "RUTA",
  {_whole('"Económico planificado"')} as "ECONOMICO_PLANIFICADO", {_whole('"Vehiculo real"')} as "VEHICULO_REAL",
  "Conductor" as "CONDUCTOR", {_clock('"Llegada al punto"')} as "LLEGADA_AL_PUNTO",
  {_clock('"Partida Planeada"')} as "PARTIDA_PLANEADA", {_clock('"Partida Real"')} as "PARTIDA_REAL",
  "Diff Partida" as "DIFF_PARTIDA", "HE" as "HE", {_clock('"Llegada Planeada"')} as "LLEGADA_PLANEADA",
  {_clock('"Llegada Real"')} as "LLEGADA_REAL", "Diff llegada" as "DIFF_LLEGADA",
  {_clock('"Tiempo Viaje"')} as "TIEMPO_VIAJE", {_real('"KM Realizado"')} as "KM_REALIZADO",
  {_real('"Vel. promedio Km"')} as "VEL_PROMEDIO_KM", {_clock('"Tiemp.Punto"')} as "TIEMPPUNTO",
  {_whole('"Pasajero"')} as "PASAJERO", {_real('"I.P.K"')} as "IPK",
  {_whole('"Status del Viaje"')} as "STATUS_DEL_VIAJE", "Desc. Status del Viaje" as "DESC_STATUS_DEL_VIAJE",
  "Viaje Editado" as "VIAJE_EDITADO", {_whole('"Jornada"')} as "POSICION", "Empresa" as "EMPRESA"
from ({raw_trips_sql(bad_days)}) raw
"""


def _gaps(bad_days: bool = True, trips: str | None = None) -> str:
    return f"""
with planned as (
  select cast(cast("FECHA" as timestamp) as date) as day, "RUTA" as route,
         cast("FECHA" as timestamp) + to_seconds({_seconds('"PARTIDA_PLANEADA"')}) as departs
  from ({trips or _typed(bad_days)}) t where "PARTIDA_PLANEADA" is not null),
steps as (
  select day, route, departs, lag(departs) over (partition by day, route order by departs) as earlier from planned)
select cast(day as varchar) as "FECHA", route as "RUTA", cast(hour(departs) as bigint) as "HORA",
       max(datesub('second', earlier, departs))/2.0::double as "INTERVALO_SEC"
from steps where earlier is not null group by all
"""


def _headways(bad_days: bool = True) -> str:
    columns = (
        '"Fecha", "Ruta", "Económico planificado", "Vehiculo real", "Conductor", "Llegada al punto", '
        '"Partida Planeada", "Partida Real", "Diff Partida", "HE", "Llegada Planeada", "Llegada Real", '
        '"Diff llegada", "Tiempo Viaje", "KM Realizado", "Vel. promedio Km", "Tiemp.Punto", "Pasajero", '
        '"I.P.K", "Status del Viaje", "Desc. Status del Viaje", "Viaje Editado", "Jornada", "Empresa"'
    )
    return f"""
with ran as (
  select distinct * from ({raw_trips_sql(bad_days)}) raw where try_cast("Status del Viaje" as double) = 1),
placed as (
  select {_day('"Fecha"')} as day, "Ruta" as route, {_seconds('"Partida Real"')} as second,
         try_cast("Vehiculo real" as double) as vehicle, {_signed('"Diff Partida"', True)} as early,
         cast('0x' || substr(md5(concat_ws('|', {columns})), 1, 15) as bigint) as order_key
  from ran),
following as (
  select *, lead(second) over (partition by day, route order by second nulls last, order_key) as next_second
  from placed)
select day, route, vehicle, second, next_second, early, next_second - second as gap,
       cast(second // 3600 as bigint) as hour,
       case when second // 3600 > 5 and second // 3600 <= 10 then 'Matutino'
            when second // 3600 > 10 and second // 3600 <= 16 then 'Intermedio'
            when second // 3600 > 16 then 'Vespertino' end as shift
from following
where day is not null and route is not null and vehicle is not null and second is not null and next_second is not null
"""


_STATE = "case when abs(early) <= 2 then 'En tiempo' when early > 2 then 'Adelanta' else 'Retrasa' end"

_KEY = (
    'cast("FECHA" as timestamp) + to_seconds('
    f'coalesce({_seconds(chr(34) + "PARTIDA_REAL" + chr(34))}, '
    f'{_seconds(chr(34) + "PARTIDA_PLANEADA" + chr(34))}, 0))'
)
_IN_WEEK = f"({_KEY} >= timestamp '2024-01-08 03:20:00' and {_KEY} < timestamp '2024-01-15 03:20:00')"
_SERVICE_WEEK = "cast(cast(date_trunc('week', {} - interval '3 hours 20 minutes') as date) as varchar)"


def _replaced(bad_days: bool) -> str:
    rows = f"({_typed(bad_days)}) t"
    return f"""
select * from {rows} where not coalesce({_IN_WEEK}, false)
union all
select * replace ("PASAJERO" + 1 as "PASAJERO") from {rows} where {_IN_WEEK}
"""


_BRAND = """case when starts_with("Can Data",'Volvo') then 'Volvo' when starts_with("Can Data",'Yutong') then 'Yutong'
  when starts_with("Can Data",'BYD') then 'BYD' when starts_with("Can Data",'Merc') then 'Mercedes Benz'
  when starts_with("Can Data",'ADennis') then 'Alexander Dennis' when starts_with("Can Data",'Scania') then 'Scania' end"""
_BRANDED = f"(select * from (select *, {_BRAND} as brand from ({can_rows_sql()}) c) b where brand is not null)"


def _can(pattern: str, group: int = 1) -> str:
    """A group of a pattern that may be absent."""
    hit = f"regexp_extract(\"Can Data\", '{pattern}', {group})"
    return f"case when regexp_matches(\"Can Data\", '{pattern}') then {hit} end"


_TANK = r"Tanque 1 y 2 = ([\d.]+) y ([\d.]+) kPa"
_TEMP = "Temperatura Baterias = ([0-9.]+) (°C),"
_MIN_MAX = r"Temperatura Baterias = ([\d.]+) (\w+), ([\d.]+) (\w+)"
_BRAKES = "Condicion de Frenos: " + ", ".join(rf"{w} = ([\d.]+)" for w in ("Del_D", "Del_I", "Tra_D1", "Tra_I1", "Tra_D2", "Tra_I2"))
_STEERING = r"ALARM Steering = (\w+), Brake = (\w+)"
_ALARM = r"ALARM Motor = (\w+), Battery = (\w+), Air = (\w+)"
_FUEL = r"Horas = ([\d.]+), Total Fuel usado = ([\d.]+)"
_PAIRS = {
    "RPM": _can(r"RPM = (\d+ rpm)"),
    "Velocidad": _can(r"Velocidad = ([\d.]+ km/h)"),
    "SOC": _can(r"SOC = (\d+ %)"),
    "Nivel": _can(r".*Nivel = (\w+)"),
    "Par": _can(r"Par = (\d+ \w+)"),
    "Presion": _can("Presion = (alta|5 bar)"),
    "Caudal": _can(r"Caudal = (alto|[\d.]+ lpm)"),
    "Solo": _can(r"Solo = (\d+ V)"),
}
_FIELDS = {
    "Tanque_1_kPa": f"{_can(_TANK, 1)} || ' kPa'",
    "Tanque_2_kPa": f"{_can(_TANK, 2)} || ' kPa'",
    "Temp_Bat_Min": f"cast({_can(_MIN_MAX, 1)} as double)",
    "Temp_Bat_Min_Tipo": _can(_MIN_MAX, 2),
    "Temp_Bat_Max": f"cast({_can(_MIN_MAX, 3)} as double)",
    "Temp_Bat_Max_Tipo": _can(_MIN_MAX, 4),
    "Temp_Bat": f"cast({_can(_TEMP, 1)} as double)",
    "Temp_Bat_Unidad": _can(_TEMP, 2),
    **{
        f"Freno_{w}": f"cast({_can(_BRAKES, i + 1)} as double)"
        for i, w in enumerate(("Del_D", "Del_I", "Tra_D1", "Tra_I1", "Tra_D2", "Tra_I2"))
    },
    "ALARM_Motor": _can(_ALARM, 1),
    "ALARM_Battery": _can(_ALARM, 2),
    "ALARM_Air": _can(_ALARM, 3),
    "ALARM_Steering": _can(_STEERING, 1),
    "ALARM_Brake": _can(_STEERING, 2),
    "Horas": f"cast({_can(_FUEL, 1)} as double)",
    "Total_Fuel_Litros": f"cast({_can(_FUEL, 2)} as double)",
}
_WORD = "split_part(\"Can Data\", ' ', 1)"
_FIELD_COLUMNS = ", ".join(f'{sql} as "{name}"' for name, sql in _FIELDS.items())
_CELLS = " union all ".join(
    f"select brand, '{name}' as \"column\", cast({sql} as varchar) as value from rows"
    for name, sql in {**_FIELDS, **_PAIRS, "Marca": _WORD, "Empresa": '"Empresa"'}.items()
)


def _stripped(expr: str) -> str:
    """Halves to even, as DuckDB's round on doubles goes away from zero."""
    return f"cast(round_even(try_cast(regexp_extract({expr}, '^([0-9.]+)', 1) as double), 0) as bigint)"


_ALTERED = f"({altered_lineitem_sql()})"
_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
_ALL = ", ".join(_LINE_COLUMNS)


def _balance(where: str = "true") -> str:
    """Every different row once, with its copies on either side."""
    return f"""
select {_ALL}, sum(here) as here, sum(there) as there
from (select {_ALL}, 1 as here, 0 as there from lineitem union all select {_ALL}, 0, 1 from {_ALTERED} x) both_sides
where {where} group by {_ALL}"""


def _counts(where: str = "true") -> str:
    return f"""
select coalesce(sum(least(here, there)), 0)::bigint as matched_rows,
  coalesce(sum(here - there) filter (here > there), 0)::bigint as only_left_rows,
  coalesce(sum(there - here) filter (there > here), 0)::bigint as only_right_rows,
  coalesce(sum(here), 0)::bigint as left_total, coalesce(sum(there), 0)::bigint as right_total
from ({_balance(where)}) balance
"""


def _differing(columns: str) -> str:
    return f"""
select {columns} from (
  select case when copy <= here then '1_left' else '2_right' end as side, {_ALL}
  from ({_balance()}) balance, unnest(range(1, (here + there)::bigint + 1)) as u(copy) where here <> there) rows
"""


ORACLE_SQL: dict[str, str] = {
    "scheduled_gap_by_hour": _gaps(),
    "guarded_rebuild": _gaps(False),
    "trips_job_gaps": _gaps(False),
    "gaps_incremental": _gaps(trips=f"""
select * replace (case when {_KEY} >= timestamp '2024-01-08 03:20:00' and {_KEY} < timestamp '2024-01-22 03:20:00'
                       then left("PARTIDA_PLANEADA", 6) || '00' else "PARTIDA_PLANEADA" end as "PARTIDA_PLANEADA") from ({_typed(False)}) r"""),
    "trips_typed": _typed(),
    "processed_csv_roundtrip": _typed(),
    "headway_punctuality": f"""
select {_stamp('day')} as "FECHA", route as "RUTA", vehicle as "ECONOMICO",
  {_stamp("timestamp '1900-01-01' + to_seconds(second)")} as "PARTIDA_REAL", {_STATE} as "ESTADO", early as "DIFF_PARTIDA",
  {_stamp('cast(day as timestamp) + to_seconds(second)')} as "TIMESTAMP_SALIDA",
  {_stamp('cast(day as timestamp) + to_seconds(next_second)')} as "SALIDA_SIGUIENTE",
  '0 days ' || {_clock_text('gap')} as "INTERVALO", gap/60.0::double as "INTERVALO_MINUTOS",
  cast(isodow(day)-1 as bigint) as "DIA_DE_LA_SEMANA", coalesce(shift,'nan') as "TURNO", hour as "FRANJA_HORARIA"
from ({_headways()}) h""",
    "headway_without_unmapped_shift": f"""
select {_stamp('day')} as "FECHA", route as "RUTA", shift as "TURNO", count(*) as n_rows,
  max(gap)/60.0::double as max_gap, min(gap)/60.0::double as min_gap
from ({_headways()}) h where shift is not null group by all""",
    "trips_job_headways": f"""
select {_SERVICE_WEEK.format('(cast(day as timestamp) + to_seconds(second))')} as service_week, route as "RUTA",
  {_STATE} as "ESTADO", count(*) as n_rows, cast(sum(gap) as bigint) as gap_seconds
from ({_headways(False)}) h group by all""",
    "signed_minutes": f"""
select "Fecha", "Ruta", "Diff Partida", "HE", {_signed('"Diff Partida"', True)} as early_departure,
  {_signed('"HE"', True)} as early_start, {_signed('"Diff llegada"', True)} as early_arrival,
  {_signed('"HE"', False)} as natural_start, {_signed('"Tiempo Viaje"', False)} as trip_minutes
from ({raw_trips_sql()}) raw""",
    "shift_by_hour": """
select cast(hour(ts) as int) as hour,
  case when hour(ts) between 6 and 10 then 'Matutino' when hour(ts) between 11 and 16 then 'Intermedio'
       when hour(ts) >= 17 then 'Vespertino' else 'nan' end as shift, count(*) as n_rows
from events group by all""",
    "shift_by_clock": """
select event_type, case when hour(ts) between 4 and 11 then 'Matutino'
  when hour(ts) between 1 and 3 then 'Ninguno' else 'Vespertino' end as shift, count(*) as n_rows
from events group by all""",
    "stamp_formats": """
with s as (
  select event_id, ts, case when event_id%4=0 then strftime(ts,'%d/%m/%Y %H:%M:%S')
    when event_id%4=1 then strftime(ts,'%Y-%m-%d %H:%M:%S') when event_id%4=2 then strftime(ts,'%-d/%-m/%Y')
    else 'sin fecha' end as stamp, event_id%4 as k from events)
select event_id, stamp, case when k<3 then strftime(date_trunc('day',ts),'%Y-%m-%d %H:%M:%S') end as day,
  case when k<2 then strftime(ts,'%H:%M:%S') when k=2 then '00:00:00' end as time_of_day,
  case when k=2 then strftime(ts,'%Y-%m-%d') end as plain_day, strftime(ts,'%d%m%y') as day_tag,
  strftime(date_trunc('day',ts),'%Y-%m-%d %H:%M:%S') as compact_day
from s""",
    "whole_second_gaps": """
with g as (select datesub('second', o_orderdate, l_shipdate) as seconds
           from lineitem join orders on l_orderkey = o_orderkey)
select seconds, count(*) as n_rows, max(seconds/60.0::double) as minutes,
  max(cast(greatest(seconds,0)//86400 as varchar) || ' days ' ||
      strftime(timestamp '2000-01-01' + to_seconds(greatest(seconds,0)%86400), '%H:%M:%S')) as late_text
from g group by seconds""",
    "missing_tokens": """
select doc_id, case when doc_id%3=0 then null when doc_id%3=1 then '-' else lang end as token,
  concat('Economico Nandu ', source) as plain, md5(translate(text, 'áéíóúüñÁÉÍÓÚÜÑ', 'aeiouunAEIOUUN')) as text_md5
from documents""",
    "service_week_totals": f"""
select {_SERVICE_WEEK.format('ts')} as week,
  cast(weekofyear(ts - interval '3 hours 20 minutes') as int) as week_number, count(*) as n_rows,
  cast(sum(cast(round(value*100) as bigint)) as bigint) as cents
from events group by all""",
    "iso_week_totals": """
select cast(cast(date_trunc('week', o_orderdate) as date) as varchar) as monday, count(*) as n_rows,
  cast(sum(cast(round(o_totalprice*100) as bigint)) as bigint) as cents
from orders group by all""",
    "fri_thu_week_totals": """
select cast(cast(o_orderdate as date) - cast((isodow(o_orderdate) + 2) % 7 as int) as varchar) as friday,
  count(*) as n_rows, cast(sum(cast(round(o_totalprice*100) as bigint)) as bigint) as cents
from orders group by all""",
    "local_day_totals": """
select cast(cast(ts - interval '6 hours' as date) as varchar) as local_day,
  cast(hour(ts - interval '6 hours') as int) as local_hour, count(*) as n_rows
from events group by all""",
    "synthetic_key_range": f"""
select "FECHA", "RUTA", "VEHICULO_REAL", "PARTIDA_REAL", "PARTIDA_PLANEADA", {_stamp(_KEY)} as key
from ({_typed()}) t where {_IN_WEEK}""",
    "window_guard_stats": f"""
select count(*) as total_rows, count(*) - count("FECHA") as bad_dates, count(*) - count("PARTIDA_REAL") as null_times,
  {_stamp(f'min(cast("FECHA" as timestamp) + to_seconds({_seconds(chr(34) + "PARTIDA_REAL" + chr(34))}))')} as min_key,
  {_stamp(f'max(cast("FECHA" as timestamp) + to_seconds({_seconds(chr(34) + "PARTIDA_REAL" + chr(34))}))')} as max_key
from ({_typed()}) t""",
    "range_replace_result": _replaced(True),
    "readers_during_swap": f"""select "FECHA", count(*) as n_rows, 0 as odd_reads from ({_replaced(False)}) t group by "FECHA\"""",
    "trips_job_corrected": _typed(False),
    "processed_names": _typed(False),
    "stamp_formats": """
select c as "column", f as format, count(*) as n_read, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last
from events, (values ('day_first', 'd/M/yyyy H:m:s[.SSSSSS]'), ('month_first', 'M/d/yyyy H:m:s[.SSSSSS]')) v(c, f)
where event_id%50<>0 group by all""",
    "csv_line_breaks": f"select event_id::varchar as event_id, event_type, note from ({event_notes_sql()}) n",
    "newest_file": """
select wanted, n_name, n_regionkey::varchar as n_regionkey from nation
join (values ('Desinc_0.csv', 0), ('Desinc_none.csv', 2)) w(wanted, region) on n_regionkey = region""",
    "newest_of_many": """
select 'Desinc_' || source || '.csv' as source_file, strftime(date '2026-07-01' + wanted::int, '%Y-%m-%d') as window_start, event_type,
  count(*) as n_rows, sum(event_id)::bigint as id_sum
from (select wanted, case when wanted < 12 then wanted else 7 end as source from range(12) w(wanted)) w
join events on event_id % 12 = source group by all""",
    "guard_verdicts": f"""
select * from (values ('empty', true, 0::bigint), ('bad_dates', true, 0), ('no_times', true, 0), ('outside', true, 0)) v(input, refused, n_rows)
union all select 'good', false, count(*) from ({_typed(False)}) t where "PARTIDA_REAL" is not null and {_IN_WEEK}""",
    "warehouse_columns": f"""
select "Ruta" as "RUTA", "Desc. Status del Viaje" as "DESC_STATUS_DEL_VIAJE", "I.P.K" as "I_P_K", count("Fecha") as "FECHA",
  count("Económico planificado") as "ECONOMICO_PLANIFICADO", count("Vel. promedio Km") as "VEL_PROMEDIO_KM", count("Tiemp.Punto") as "TIEMP_PUNTO"
from ({raw_trips_sql()}) r group by all""",
    "dump_csv": f"""
select side, l_returnflag, count(*) as n_rows, sum(l_orderkey)::bigint as key_sum from ({_differing('*')}) d group by all""",
    "can_range_job": f"""
select d.day as report_day, n.brand, count(b.brand) as n_rows, cast(1 as int) as n_skipped
from (values ('2025-03-01'),('2025-03-02'),('2025-03-04')) d(day)
cross join (values ('Volvo'),('Yutong'),('BYD'),('Mercedes Benz'),('Alexander Dennis'),('Scania')) n(brand)
left join {_BRANDED} b on n.brand = b.brand and strftime(strptime(b."Fecha", '%d/%m/%Y %H:%M:%S') + interval 30 year, '%Y-%m-%d') = d.day
group by d.day, n.brand""",
    "can_range_all": f"""
select strftime(date '2025-03-01' + (d.day + (d.day >= 20)::int)::int, '%Y-%m-%d') as report_day, n.brand, count(b.brand) as n_rows, cast(1 as int) as n_skipped,
  nullif(count(b.brand), 0) as n_stored, sum(b.l_orderkey)::bigint as key_sum,
  strftime(min(strptime(b."Fecha", '%d/%m/%Y %H:%M:%S')), '%Y-%m-%d') as first_date
from range(30) d(day)
cross join (values ('Volvo'),('Yutong'),('BYD'),('Mercedes Benz'),('Alexander Dennis'),('Scania')) n(brand)
left join {_BRANDED} b on n.brand = b.brand and b.l_orderkey % 30 = d.day
group by d.day, n.brand""",
    "headway_inliers": f"""
select route as "RUTA", count(*) + 1 as n_before, cast(0 as bigint) as planted_left, true as share_kept
from ({_headways()}) h group by route""",
    "landed_versions": f"""
select "Ruta", "Económico" || 'x' as "_c1", "Turno", 'report.csv' as source_file from ({fleet_rows_sql()}) f""",
    "append_strict": f"""
select "Ruta" as ruta, "Turno" as turno, 2 * count(*) as n_rows, cast(3 as int) as refused
from ({fleet_rows_sql()}) f group by all""",
    "range_replace_stored": _replaced(False),
    "landed_report": f"""
select "Ruta", "Jornada", "Económico", "Empresa Programado", "Empresa Real", "Date", "Turno",
  '2026-07-01' as window_start from ({fleet_rows_sql()}) f""",
    "multiset_audit_summary": _counts(),
    "audit_by_day": """
with changed as (select * replace (case when day(l_shipdate) = 1 then l_quantity + 1 else l_quantity end as l_quantity) from lineitem),
  gone as (select count(*) as n from (select * from lineitem except all select * from changed)),
  come as (select count(*) as n from (select * from changed except all select * from lineitem))
select (select count(*) from lineitem) - gone.n as matched_rows, gone.n as only_left_rows, come.n as only_right_rows,
  (select count(*) from lineitem) as left_total, (select count(*) from changed) as right_total,
  (select count(distinct l_shipdate::date) from lineitem) as n_days,
  (select count(distinct l_shipdate::date) from lineitem where day(l_shipdate) = 1) as n_differing
from gone, come""",
    "multiset_audit_dump": f"""
{_differing("side, " + ", ".join(c if c != "l_shipdate" else "strftime(l_shipdate,'%Y-%m-%d %H:%M:%S') as l_shipdate" for c in _LINE_COLUMNS))}""",
    "multiset_audit_all": f"select side, l_quantity, count(*) as n_rows from ({_differing('*')}) r group by all",
    "multiset_except": f"""
select '1_left' as side, count(*) as n_rows, cast(sum(l_orderkey) as bigint) as key_sum
from (select {_ALL} from lineitem except all select {_ALL} from {_ALTERED} x) d
union all
select '2_right' as side, count(*) as n_rows, cast(sum(l_orderkey) as bigint) as key_sum
from (select {_ALL} from {_ALTERED} x except all select {_ALL} from lineitem) d""",
    "parity_report": f"""
select 'same' as pair, cast(0 as int) as code, cast(1 as int) as n_messages, count(*) as matched_rows,
  cast(0 as bigint) as only_left_rows, cast(0 as bigint) as only_right_rows, count(*) as left_total, count(*) as right_total
from orders
union all select 'altered', 1, 0, * from ({_counts("l_shipdate >= timestamp '1997-01-01'")}) s
union all select 'other_schema', 2, 11, null, null, null, null, null""",
    "non_null_counts": f"""
select count("FECHA") as "FECHA", count("RUTA") as "RUTA", count("PARTIDA_REAL") as "PARTIDA_REAL",
  count("PARTIDA_PLANEADA") as "PARTIDA_PLANEADA", count("LLEGADA_REAL") as "LLEGADA_REAL" from ({_typed()}) t""",
    "can_normalize": f"""
select l_orderkey, l_linenumber, "Can Data" as plain from ({can_rows_sql()}) c""",
    "can_fields": f"""
select l_orderkey, l_linenumber, brand, {_WORD} as "Marca", {_FIELD_COLUMNS} from {_BRANDED} b""",
    "can_map_pairs": "select * from ("
    + " union all ".join(
        f"select l_orderkey, l_linenumber, brand, '{k}' as key, {sql} as value from {_BRANDED} b" for k, sql in _PAIRS.items()
    )
    + ") p where value is not null",
    "can_unit_profile": f"""
with rows as (select * from {_BRANDED} b),
cells as (select * from ({_CELLS}) c where value is not null),
units as (select *, case when regexp_matches(value, '^[-+]?[0-9]+(\\.[0-9]+)?\\s*[%°a-zA-Z/]+$')
                    then regexp_extract(value, '([%°a-zA-Z/]+)$', 1) end as unit from cells),
per_unit as (select brand, "column", unit, count(*) as n from units group by all)
select brand, "column", sum(n)::bigint as n_values, coalesce(sum(n) filter (unit is not null), 0)::bigint as n_with_unit,
  coalesce(sum(n) filter (unit is not null), 0)::bigint / sum(n)::bigint as share,
  (list(unit order by n desc, unit) filter (unit is not null))[1] as unit,
  "column" in ({", ".join(f"'{k}'" for k in _PAIRS)}) as generic
from per_unit group by brand, 2""",
    "can_wide_clean": f"""
select brand, l_orderkey, l_linenumber,
  strftime(strptime("Fecha", '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d 00:00:00') as "Fecha", split_part("Fecha",' ',2) as "Hora",
  {_stripped(_FIELDS["Tanque_1_kPa"])} as "Tanque_1_kPa (kPa)", {_stripped(_FIELDS["Tanque_2_kPa"])} as "Tanque_2_kPa (kPa)",
  {_FIELDS["Temp_Bat"]} as "Temp_Bat", {_FIELDS["Temp_Bat_Unidad"]} as "Temp_Bat_Unidad",
  {", ".join(f'{_FIELDS[c]} as "{c}"' for c in _FIELDS if not c.startswith(("Tanque", "Temp_Bat_Unidad")) and c != "Temp_Bat")},
  {_PAIRS["Presion"]} as "Presion", {_stripped(_PAIRS["Par"])} as "Par (Nm)", {_stripped(_PAIRS["Caudal"])} as "Caudal (lpm)",
  {_stripped(_PAIRS["Solo"])} as "Solo (V)",
  {_PAIRS["Nivel"]} as "Nivel", {_stripped(_PAIRS["RPM"])} as "RPM (rpm)", {_stripped(_PAIRS["SOC"])} as "SOC (%)",
  {_stripped(_PAIRS["Velocidad"])} as "Velocidad (km/h)"
from {_BRANDED} b""",
    "can_brand_counts": f"""
select n.brand, count(b.brand) as n_rows
from (values ('Volvo'),('Yutong'),('BYD'),('Mercedes Benz'),('Alexander Dennis'),('Scania')) n(brand)
left join {_BRANDED} b on n.brand = b.brand group by n.brand""",
    "fleet_snapshot": f"""
select '2026-07-01 00:00:00' as date, "Turno" as turno, "Ruta" as ruta, cast(try_cast("Jornada" as double) as bigint) as jornada,
  "Económico" as economico, "Empresa Programado" as empresa_programado, "Empresa Real" as empresa_real
from ({fleet_rows_sql()}) f""",
    "fleet_job": f"""
select '2026-07-01 00:00:00' as date, 'Vespertino' as turno, "Ruta" as ruta, cast(try_cast("Jornada" as double) as bigint) as jornada,
  "Económico" as economico, "Empresa Programado" as empresa_programado, "Empresa Real" as empresa_real
from ({fleet_rows_sql()}) f cross join (values (1), (2)) twice(n)""",
    "fleet_stamped": f"""
select '2026-07-01 00:00:00' as date, 'Vespertino' as turno, "Ruta" as ruta, cast(try_cast("Jornada" as double) as bigint) as jornada,
  "Económico" as economico, "Empresa Programado" as empresa_programado, "Empresa Real" as empresa_real
from ({fleet_rows_sql()}) f""",
}
