"""Registered queries over joins that account for every row: seasons that differ or are missing."""

from pyspark.sql import functions as F

from pitchlake.sources import tables
from verification import views
from verification.oracle_views import STATS
from verification.registry import query, with_

# Every 19th match loses its id in the statistics, every 17th has one that no match has, every
# 11th no season, every 13th the other spelling of it.
DRIFTED = STATS + """,
drifted AS (
  SELECT CASE WHEN id_jogo % 19 = 0 THEN NULL WHEN id_jogo % 17 = 0 THEN id_jogo + 1000000000
    ELSE id_jogo END AS id_jogo, periodo, clube,
    CASE WHEN id_jogo % 11 = 0 THEN NULL
      WHEN id_jogo % 13 = 0 AND contains(temporada, '/') THEN substr(temporada, 1, 4)
      WHEN id_jogo % 13 = 0 THEN temporada || '/' || CAST(CAST(temporada AS INTEGER) + 1 AS VARCHAR)
      ELSE temporada END AS temporada, total_shots
  FROM team_stats),
accounted AS (
  SELECT d.*, m.temporada AS temporada_jogo, m.data, m.campeonato, m.casa, m.fora,
    CASE WHEN d.id_jogo IS NULL THEN 'sem id' WHEN m.id_jogo IS NULL THEN 'sem jogo'
      WHEN d.temporada = m.temporada THEN 'ok' WHEN d.temporada IS NULL THEN 'sem temporada'
      ELSE 'temporada difere' END AS situacao
  FROM drifted d LEFT JOIN matches m ON d.id_jogo = m.id_jogo)"""


def drifted(spark, sf):
    key, season = F.col("id_jogo"), F.col("temporada")
    other = F.when(season.contains("/"), F.substring(season, 1, 4)).otherwise(
        F.concat(season, F.lit("/"), (season.try_cast("int") + 1).cast("string")))
    stats = views.team_stats(spark, sf).select("id_jogo", "periodo", "clube", "temporada", "total_shots")
    return stats.withColumns({
        "temporada": F.when(key % 11 != 0, F.when(key % 13 == 0, other).otherwise(season)),
        "id_jogo": F.when(key % 19 != 0, F.when(key % 17 == 0, key + 1000000000).otherwise(key)),
    })


@query("j01_join_audit", with_(DRIFTED, """
SELECT situacao, temporada, temporada_jogo, count(*) AS linhas, count(DISTINCT id_jogo) AS jogos
FROM accounted GROUP BY ALL"""))
def j01(spark, sf):
    return tables.join_audit(drifted(spark, sf), views.matches(spark, sf))


@query("j02_every_row_accounted", with_(DRIFTED, """
SELECT id_jogo, periodo, clube, temporada, temporada_jogo, total_shots, CAST(data AS VARCHAR) AS data,
  campeonato, situacao FROM accounted"""))
def j02(spark, sf):
    # Matches that come again without their competition do not multiply rows.
    m = views.matches(spark, sf)
    again = m.filter(F.col("id_jogo") % 5 == 0).withColumn("campeonato", F.lit(None).cast("string"))
    return tables.accounted(drifted(spark, sf), m.unionByName(again)).select(
        "id_jogo", "periodo", "clube", "temporada", "temporada_jogo", "total_shots",
        F.col("data").cast("string").alias("data"), "campeonato", "situacao")


@query("j03_stats_of_any_season", with_(DRIFTED, """
SELECT id_jogo, periodo, clube, temporada_jogo AS temporada, total_shots, CAST(data AS VARCHAR) AS data,
  CASE WHEN clube = casa THEN 'Casa' WHEN clube = fora THEN 'Fora' ELSE 'Verificar' END AS mando
FROM accounted WHERE situacao IN ('ok', 'sem temporada', 'temporada difere')"""))
def j03(spark, sf):
    return tables.team_stats_of(drifted(spark, sf), views.matches(spark, sf)).select(
        "id_jogo", "periodo", "clube", "temporada", "total_shots", F.col("data").cast("string").alias("data"), "mando")


@query("j04_pruned_after_agreement", with_(DRIFTED, """
SELECT id_jogo, periodo, clube, total_shots FROM accounted WHERE temporada_jogo = '1997'"""))
def j04(spark, sf):
    """Statistics stored under their match's season: the pruned join of a season loses no row."""
    m = views.matches(spark, sf)
    agreed = tables.with_match_season(drifted(spark, sf), m)
    return tables.team_stats_of(agreed, tables.matches_in(m, "1997"), seasons=["1997"]).select(
        "id_jogo", "periodo", "clube", "total_shots")
