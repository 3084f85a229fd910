"""Registered queries: leader lists in one pass, scores over time, names under a collation, bucketed and moved rows."""

import uuid

from pyspark.sql import functions as F

from pitchlake.operators import naming, sinks
from pitchlake.operators import players as pl
from pitchlake.session import shared_dir
from pitchlake.sources import mixed, tables
from verification import views
from verification.oracle_views import GOALS, MATCHES, PLAYERS, STATS
from verification.queries_players import rows
from verification.registry import query, with_

# --- L12 .. L14 in one pass --------------------------------------------------------------
LISTS = {"minutes_played": "minutes", "goals": "goals", "goal_assist": "assists", "participacao": "goals + assists"}


def _lists_sql(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    parts = [f"""SELECT {lead}player_id, name, {name} AS lista, '{metric}' AS metrica, CAST(sum({value}) AS DOUBLE) AS valor
  FROM pl GROUP BY {lead}player_id, name{extra}"""
             for metric, value in LISTS.items() for name, extra in (("'Geral'", ""), ("position", ", position"))]
    return f"""SELECT * REPLACE (CAST(posicao AS INTEGER) AS posicao) FROM (
  SELECT *, row_number() OVER (PARTITION BY {lead}metrica, lista ORDER BY valor DESC, name, player_id) AS posicao
  FROM ({' UNION ALL '.join(parts)}) WHERE valor > 0) WHERE posicao <= 10"""


@query("l24_leader_lists", with_(PLAYERS, _lists_sql()))
def l24(spark, sf):
    return pl.leader_lists(rows(spark, sf), list(LISTS))


@query("l24_leader_lists_by_competition", with_(PLAYERS, _lists_sql("campeonato")))
def l24_competition(spark, sf):
    return pl.leader_lists(rows(spark, sf), list(LISTS), by=["campeonato"])


# --- scores over time --------------------------------------------------------------------
# A goal belongs to the match of its user id: to the home club on even events; every 40th has
# another club, every 50th no minute.
SCORED = MATCHES + """,
""" + GOALS.strip().replace("goals AS (", "raw_goals AS (") + """,
scored AS (SELECT g.id_jogo, CASE WHEN ordem % 40 = 0 THEN 'X' WHEN ordem % 2 = 0 THEN casa ELSE fora END AS clube_gol,
  CASE WHEN ordem % 50 <> 1 THEN minutos END AS minutos, ordem FROM raw_goals g JOIN matches m USING (id_jogo)),
changes AS (SELECT id_jogo, minutos AS inicio, CAST(clube_gol = casa AS INTEGER) AS c, CAST(clube_gol = fora AS INTEGER) AS f
  FROM scored JOIN matches USING (id_jogo) WHERE minutos >= 0 AND clube_gol IN (casa, fora)
  UNION ALL SELECT id_jogo, 0, 0, 0 FROM matches),
minutes AS (SELECT id_jogo, inicio, sum(c) AS c, sum(f) AS f FROM changes GROUP BY ALL),
timeline AS (SELECT id_jogo, casa, fora, inicio,
  CAST(coalesce(lead(inicio) OVER w, greatest(90, inicio + 1)) AS INTEGER) AS fim,
  CAST(sum(c) OVER w AS INTEGER) AS gols_casa, CAST(sum(f) OVER w AS INTEGER) AS gols_fora
  FROM minutes JOIN matches USING (id_jogo) WINDOW w AS (PARTITION BY id_jogo ORDER BY inicio)),
sides AS (SELECT id_jogo, casa AS clube, fim - inicio AS m, sign(gols_casa - gols_fora) AS s FROM timeline
  UNION ALL SELECT id_jogo, fora, fim - inicio, sign(gols_fora - gols_casa) FROM timeline)"""


def scored(spark, sf):
    m = views.matches(spark, sf).select("id_jogo", "casa", "fora")
    n = F.col("ordem")
    club = F.when(n % 40 == 0, "X").when(n % 2 == 0, F.col("casa")).otherwise(F.col("fora"))
    goals = views.goals(spark, sf).join(m, "id_jogo").select(
        "id_jogo", club.alias("clube_gol"), F.when(n % 50 != 1, F.col("minutos")).alias("minutos"), "ordem")
    return goals, m


@query("l25_score_timeline", with_(SCORED, "SELECT * FROM timeline"))
def l25(spark, sf):
    return pl.score_timeline(*scored(spark, sf))


@query("l26_minutes_by_state", with_(SCORED, """
SELECT clube, count(DISTINCT id_jogo) AS jogos, CAST(sum(m) AS BIGINT) AS minutos,
  CAST(coalesce(sum(m) FILTER (WHERE s = 1), 0) AS BIGINT) AS vencendo,
  CAST(coalesce(sum(m) FILTER (WHERE s = 0), 0) AS BIGINT) AS empatando,
  CAST(coalesce(sum(m) FILTER (WHERE s = -1), 0) AS BIGINT) AS perdendo FROM sides GROUP BY clube"""))
def l26(spark, sf):
    return pl.minutes_by_state(pl.score_timeline(*scored(spark, sf)))


@query("l27_state_before_each_goal", with_(SCORED, """
SELECT s.id_jogo, s.ordem, s.clube_gol, t.gols_casa, t.gols_fora,
  CASE sign(CASE WHEN clube_gol = casa THEN gols_casa - gols_fora ELSE gols_fora - gols_casa END)
    WHEN 1 THEN 'vencendo' WHEN 0 THEN 'empatando' ELSE 'perdendo' END AS estado
FROM scored s JOIN timeline t ON s.id_jogo = t.id_jogo AND s.minutos - 1 >= t.inicio AND s.minutos - 1 < t.fim
WHERE clube_gol IN (casa, fora)"""))
def l27(spark, sf):
    goals, m = scored(spark, sf)
    before = goals.withColumn("antes", F.col("minutos") - 1)
    return pl.at_score(before, pl.score_timeline(goals, m), "antes", "clube_gol").filter("estado IS NOT NULL").select(
        "id_jogo", "ordem", "clube_gol", "gols_casa", "gols_fora", "estado")


# --- names under a collation ---------------------------------------------------------------
# The dictionary has São 0, São 1, ...; every third club again without its accent under another
# id, which makes the name ambiguous where neither is written exactly.
CLUBS = """
clubs AS (SELECT CAST(n_nationkey AS BIGINT) AS club_id, 'São ' || n_name AS nome FROM nation
  UNION ALL SELECT n_nationkey + 100, 'SAO ' || n_name FROM nation WHERE n_nationkey % 3 = 0),
given AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'São ' || n_name WHEN 1 THEN 'sao ' || lower(n_name)
    WHEN 2 THEN 'SÃO ' || n_name || ' ' ELSE 'Unknown ' || n_name END AS clube
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
keyed AS (SELECT *, strip_accents(lower(nome)) AS k FROM clubs),
loose AS (SELECT k, min(club_id) AS club_id, min(nome) AS nome, count(DISTINCT club_id) AS n FROM keyed GROUP BY k)"""


def clubs(spark, sf):
    n = views.table(spark, sf, "nation")
    key = F.col("n_nationkey").cast("bigint")
    first = n.select(key.alias("club_id"), F.concat(F.lit("São "), "n_name").alias("nome"))
    return first.unionByName(n.filter(key % 3 == 0).select((key + 100).alias("club_id"), F.concat(F.lit("SAO "), "n_name").alias("nome")))


def given(spark, sf):
    n = F.broadcast(views.table(spark, sf, "nation"))  # 25 rows at every scale
    c = views.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey") % 4
    name = (F.when(k == 0, F.concat(F.lit("São "), "n_name")).when(k == 1, F.concat(F.lit("sao "), F.lower("n_name")))
            .when(k == 2, F.concat(F.lit("SÃO "), "n_name", F.lit(" "))).otherwise(F.concat(F.lit("Unknown "), "n_name")))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", name.alias("clube"))


@query("p17_club_names_under_collation", with_(CLUBS, """
SELECT c_custkey, clube, coalesce(e.club_id, CASE WHEN l.n = 1 THEN l.club_id END) AS club_id,
  coalesce(e.nome, CASE WHEN l.n = 1 THEN l.nome END) AS nome,
  CASE WHEN e.club_id IS NOT NULL THEN 'exato' WHEN l.n = 1 THEN 'comparado' WHEN l.n > 1 THEN 'ambiguo' END AS por
FROM given LEFT JOIN clubs e ON trim(clube) = e.nome LEFT JOIN loose l ON strip_accents(lower(trim(clube))) = l.k"""))
def p17_collation(spark, sf):
    return naming.club_by_name(given(spark, sf), clubs(spark, sf), "clube")


@query("p17_ambiguous_names", with_(CLUBS, """
SELECT min(nome) AS nome, string_agg(DISTINCT nome, '|' ORDER BY nome) AS nomes, count(DISTINCT club_id) AS clubes
FROM keyed GROUP BY k HAVING count(DISTINCT club_id) > 1"""))
def p17_ambiguous(spark, sf):
    return naming.ambiguous_names(clubs(spark, sf)).select(
        "nome", F.concat_ws("|", "nomes").alias("nomes"), F.size("club_ids").cast("bigint").alias("clubes"))


# --- bucketed storage, moved rows ----------------------------------------------------------
def bucketed(spark, sf, buckets=8):
    """Matches and team statistics stored in buckets of the match id, ``buckets`` at least."""
    out = []
    both = {"matches": views.matches(spark, sf).drop("_cents"), "team_stats": views.team_stats(spark, sf)}
    buckets = sinks.buckets_for(*both.values(), least=buckets)
    for name, df in both.items():
        table = f"{name}_{uuid.uuid4().hex}"
        out.append(sinks.store_bucketed(df, table, shared_dir(spark, table), buckets))
    return out


@query("k09_bucketed_statistics", with_(STATS, """
SELECT id_jogo, periodo, clube, CAST(data AS VARCHAR) AS data, total_shots,
  CASE WHEN clube = casa THEN 'Casa' WHEN clube = fora THEN 'Fora' ELSE 'Verificar' END AS mando
FROM team_stats JOIN matches USING (id_jogo)"""))
def k09(spark, sf):
    m, s = bucketed(spark, sf)
    return tables.team_stats_of(s, m).select(
        "id_jogo", "periodo", "clube", F.col("data").cast("string").alias("data"), "total_shots", "mando")


@query("k10_matches_moved_to_another_season", with_(MATCHES, """
SELECT id_jogo, CASE WHEN temporada = '1995' AND id_jogo % 2 = 0 THEN '1995/1996' WHEN temporada = '1996' THEN '96'
  ELSE temporada END AS temporada, CAST(CASE WHEN temporada = '1996' OR (temporada = '1995' AND id_jogo % 2 = 0) THEN 7 ELSE gols_casa END AS INTEGER) AS gols_casa
FROM matches"""))
def k10(spark, sf):
    """Half of one season and all of another come back under other names."""
    path = shared_dir(spark, "moved")
    m = views.matches(spark, sf).select("id_jogo", "gols_casa", "temporada")
    m.write.partitionBy("temporada").parquet(path)
    season = F.col("temporada")
    half = (season == "1995") & (F.col("id_jogo") % 2 == 0)
    new = m.filter(half | (season == "1996")).withColumns({
        "temporada": F.when(season == "1996", "96").otherwise("1995/1996"), "gols_casa": F.lit(7)})
    sinks.write_changed(new, path, "temporada")
    return spark.read.schema("id_jogo BIGINT, gols_casa INT, temporada STRING").parquet(path)


# --- files of different layouts in one folder ----------------------------------------------
@query("s20_history_of_three_layouts", with_(MATCHES, """
SELECT id_jogo % 3 AS layout, CASE WHEN id_jogo % 20 = 0 THEN 'data' WHEN id_jogo % 21 = 0 THEN 'campos' END AS motivo,
  CASE WHEN ok THEN CAST(data AS VARCHAR) END AS data, CASE WHEN ok THEN campeonato END AS campeonato,
  CASE WHEN ok THEN temporada END AS temporada, CASE WHEN ok THEN casa END AS casa,
  CASE WHEN ok THEN coalesce(gols_casa, 0) END AS gols_casa, CASE WHEN ok THEN coalesce(gols_fora, 0) END AS gols_fora,
  CASE WHEN ok THEN fora || CASE WHEN id_jogo % 3 = 0 THEN ', FC' ELSE '' END END AS fora
FROM (SELECT *, id_jogo % 20 <> 0 AND id_jogo % 21 <> 0 AS ok FROM matches)"""))
def s20(spark, sf):
    """One read of a folder with commas and quotes, semicolons and other words in another order, and no header."""
    m = views.matches(spark, sf)
    k = F.col("id_jogo")
    goals = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("gols_casa", "gols_fora")}
    path = shared_dir(spark, "layouts")

    def part(i, date, order, names, sep, header):
        day = F.when(k % 20 == 0, "someday").otherwise(date)
        away = F.concat("fora", F.lit(", FC")) if i == 0 else F.col("fora")
        own = {"data": day, "campeonato": F.col("campeonato"), "temporada": F.col("temporada"), "casa": F.col("casa"),
               "fora": F.when((k % 21 == 0) & (k % 20 != 0), F.concat(away, F.lit(f"{sep}x{sep}y"))).otherwise(
                   F.concat(F.lit('"'), away, F.lit('"')) if i == 0 else away), **goals}
        rows_ = m.filter(k % 3 == i).select(F.concat_ws(sep, *[own[c] for c in order]).alias("value"))
        if header:  # every file of the layout begins with it; lines are written as they are
            verbatim = {"header": True, "sep": "\u0001", "quote": "", "escapeQuotes": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            rows_.toDF(sep.join(names)).write.options(**verbatim).csv(f"{path}/{i}")
        else:
            rows_.write.text(f"{path}/{i}")

    plain = ["data", "campeonato", "temporada", "casa", "gols_casa", "gols_fora", "fora"]
    part(0, F.date_format("data", "yyyy-MM-dd"), plain, ["Data", "Torneio", "Temporada", "Mandante", "Gols Mandante", "Gols Visitante", "Visitante"], ",", True)
    part(1, F.date_format("data", "dd/MM/yyyy"), ["temporada", "casa", "gols_casa", "gols_fora", "data", "campeonato", "fora"],
         ["Season", "Home", "Home Goals", "Gols Away", "Date", "Competição", "Away"], ";", True)
    part(2, F.date_format("data", "yyyy/MM/dd"), plain, [], "|", False)
    got = mixed.read_mixed_history(spark, f"{path}/*")
    layout = F.regexp_extract("arquivo", "/([0-2])/part-", 1).cast("bigint")
    return got.select(layout.alias("layout"), "motivo", F.col("data").cast("string").alias("data"), *[c for c in plain if c != "data"])
