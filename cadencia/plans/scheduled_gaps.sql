-- Half the largest gap between planned departures, per date, route and hour.
-- Departures are reduced to one row per second first: the window then sees at most 86,400 rows per
-- date and route. Two departures in the same second are a gap of zero. All trip statuses count.
WITH instants AS (
  SELECT
    CAST(FECHA AS DATE) AS FECHA,
    RUTA,
    hour(PARTIDA_PLANEADA) * 3600 + minute(PARTIDA_PLANEADA) * 60 + CAST(second(PARTIDA_PLANEADA) AS INT) AS second_of_day,
    count(*) AS departures
  FROM IDENTIFIER(:source_table)
  WHERE PARTIDA_PLANEADA IS NOT NULL AND FECHA IS NOT NULL
  GROUP BY ALL
),
gaps AS (
  SELECT
    FECHA,
    RUTA,
    CAST(second_of_day DIV 3600 AS BIGINT) AS HORA,
    greatest(
      second_of_day - lag(second_of_day) OVER (PARTITION BY FECHA, RUTA ORDER BY second_of_day),
      CASE WHEN departures > 1 THEN 0 END
    ) AS gap
  FROM instants
)
SELECT FECHA, RUTA, HORA, CAST(max(gap) AS DOUBLE) / 2 AS INTERVALO_SEC
FROM gaps
WHERE gap IS NOT NULL
GROUP BY FECHA, RUTA, HORA
