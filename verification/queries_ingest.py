"""Registered queries over sources, cleaning, sinks and the incremental load."""

from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.functions import fixed, labels, numeric, text
from pitchlake.operators import naming, results, sinks
from pitchlake.operators.club_games import club_games
from pitchlake.session import shared_dir
from pitchlake.sources import documents, files, tables
from pitchlake.streaming import incremental
from verification import docs, views
from verification.oracle_views import GAMES, GOALS, MATCHES, PLAYERS, STATS
from verification.registry import half_up, pct, query, with_



def loaded():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def iso(c):
    return F.col(c).cast("string").alias(c)


def dbl(c):
    return F.col(c).cast("double").alias(c)


# --- P: labels --------------------------------------------------------------------
@query("p01_match_labels", with_(MATCHES, """
SELECT id_jogo, w AS vencedor, CASE WHEN gols_casa > gols_fora THEN fora
  WHEN gols_fora > gols_casa THEN casa WHEN gols_casa = gols_fora THEN 'Empate' END AS perdedor,
  gols_casa + gols_fora AS total_gols,
  CAST(CASE WHEN gols_casa > gols_fora THEN odd_casa WHEN gols_fora > gols_casa THEN odd_fora END
    AS DOUBLE) AS odd_vencedora,
  CASE WHEN w IS NULL THEN NULL WHEN w = casa THEN 3 WHEN w = 'Empate' THEN 1 ELSE 0 END AS pontos_casa,
  CASE WHEN w IS NULL THEN NULL WHEN w = fora THEN 3 WHEN w = 'Empate' THEN 1 ELSE 0 END AS pontos_fora,
  coalesce(gols_casa, 0) || '-' || coalesce(gols_fora, 0) AS placar
FROM (SELECT *, CASE WHEN gols_casa > gols_fora THEN casa WHEN gols_fora > gols_casa THEN fora
  WHEN gols_casa = gols_fora THEN 'Empate' END AS w FROM matches)"""))
def p01(spark, sf):
    return views.matches(spark, sf).select(
        "id_jogo", labels.winner().alias("vencedor"), labels.loser().alias("perdedor"),
        labels.total_goals().alias("total_gols"),
        labels.winner_odds().cast("double").alias("odd_vencedora"),
        labels.points("Casa").alias("pontos_casa"), labels.points("Fora").alias("pontos_fora"),
        labels.scoreline().alias("placar"))


@query("p07_side_opponent_goals", with_(MATCHES, """
SELECT id_jogo, CASE 'NATION_3' WHEN casa THEN 'Casa' WHEN fora THEN 'Fora' ELSE 'Verificar' END
  AS mando, CASE 'NATION_3' WHEN casa THEN fora WHEN fora THEN casa END AS adversario,
  CASE 'NATION_3' WHEN casa THEN gols_casa WHEN fora THEN gols_fora END AS gols_favor,
  CASE 'NATION_3' WHEN casa THEN gols_fora WHEN fora THEN gols_casa END AS gols_contra
FROM matches"""))
def p07(spark, sf):
    club = F.lit("NATION_3")
    return views.matches(spark, sf).select(
        "id_jogo", labels.side_of(club).alias("mando"), labels.opponent_of(club).alias("adversario"),
        labels.goals_for(club).alias("gols_favor"), labels.goals_against(club).alias("gols_contra"))


@query("p09_positions_and_involvement", with_(PLAYERS, """
SELECT id_jogo, player_id, position, goals + assists AS participacao,
  CASE position WHEN 'Goleiro' THEN 1 WHEN 'Defensor' THEN 2 WHEN 'Meio-campo' THEN 3
  WHEN 'Atacante' THEN 4 ELSE 5 END AS ordem FROM player_stats"""))
def p09(spark, sf):
    name = labels.position_name(F.col("position"))
    return views.player_stats(spark, sf).select(
        "id_jogo", "player_id", name.alias("position"),
        labels.goal_involvement().alias("participacao"), labels.position_order(name).alias("ordem"))


@query("p10_analysed_clubs", with_(MATCHES, """
SELECT id_jogo, c AS clube_analise FROM matches, (VALUES ('NATION_3'), ('NATION_7')) v(c)
WHERE casa = c OR fora = c"""))
def p10(spark, sf):
    return views.matches(spark, sf).select(
        "id_jogo", F.explode(labels.analysed_clubs("NATION_3", "NATION_7")).alias("clube_analise"))


@query("p11_percent_and_fraction_text", with_(STATS, f"""
SELECT id_jogo, periodo, clube,
  CAST(TRY_CAST(replace(replace(ball_possession, '%', ''), ',', '.') AS DECIMAL(9,3)) AS DOUBLE) AS posse,
  CAST(w AS INTEGER) AS certos, CAST(t AS INTEGER) AS total, {half_up('w', 't', factor=100)} AS acerto
FROM (SELECT *, CAST(split_part(crosses, '/', 1) AS BIGINT) AS w,
  CAST(regexp_extract(crosses, '/(\\d+)', 1) AS BIGINT) AS t FROM team_stats)"""))
def p11(spark, sf):
    return views.team_stats(spark, sf).select(
        "id_jogo", "periodo", "clube", text.percent(F.col("ball_possession")).alias("posse"),
        text.won_of_total(F.col("crosses")).alias("f"),
    ).select("id_jogo", "periodo", "clube", "posse", "f.*")


@query("p13_numbers_from_text", """
SELECT event_id, CASE WHEN k = 0 THEN CAST(event_id AS DOUBLE) WHEN k = 1 THEN event_id + 0.5
  WHEN k = 4 THEN 7.0 END AS numero,
  CAST(CASE WHEN k < 2 THEN event_id WHEN k = 4 THEN 7 ELSE 0 END AS INTEGER) AS inteiro,
  CASE WHEN k = 0 THEN CAST(event_id AS VARCHAR) WHEN k = 1 THEN event_id || '.5'
  WHEN k = 4 THEN ' 7 ' WHEN k = 5 THEN 'abc' END AS texto
FROM (SELECT event_id, event_id % 6 AS k FROM events)""")
def p13(spark, sf):
    key = F.col("event_id")
    k = key % 6
    raw = (F.when(k == 0, key.cast("string")).when(k == 1, F.concat(key.cast("string"), F.lit(".5")))
           .when(k == 2, "").when(k == 3, "nan").when(k == 4, " 7 ").otherwise("abc"))
    return views.table(spark, sf, "events").select("event_id", raw.alias("r")).select(
        "event_id", text.number(F.col("r")).alias("numero"),
        text.number(F.col("r"), "int", 0).alias("inteiro"),
        text.blank_to_null(F.col("r")).alias("texto"))


@query("p14_dates_in_three_layouts", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS data
FROM orders""")
def p14(spark, sf):
    k, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    raw = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd HH:mm"))
           .when(k == 1, F.date_format(d, "dd/MM/yyyy"))
           .when(k == 2, F.concat(F.lit(" "), F.date_format(d, "dd-MM-yyyy"), F.lit("\t\r\n")))
           .when(k == 3, F.concat(F.date_format(d, "dd/MM/yyyy"), F.lit(" 10:00")))
           .otherwise("31-31-x"))
    return views.table(spark, sf, "orders").select(
        "o_orderkey", text.parse_date(raw).cast("string").alias("data"))


EPOCH_SQL = ("(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 "
             "+ o_orderkey * 977 % 86400)")


@query("p15_local_kickoff", f"""
SELECT o_orderkey, strftime(t, '%Y-%m-%d') AS data, strftime(t, '%H:%M') AS hora
FROM (SELECT o_orderkey, make_timestamp(({EPOCH_SQL} - 10800) * 1000000) AS t FROM orders)""")
def p15(spark, sf):
    return views.table(spark, sf, "orders").select(
        "o_orderkey", text.local_date(docs.kickoff()).cast("string").alias("data"),
        text.local_time(docs.kickoff()).alias("hora"))


@query("p16_competition_names", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Brasileiro' WHEN 1 THEN 'La Liga'
  WHEN 2 THEN 'Copa X' ELSE 'Liga dos Campeões' END AS campeonato FROM orders""")
def p16(spark, sf):
    rows = views.table(spark, sf, "orders").select(
        "o_orderkey", docs.pick(docs.COMPETITIONS, F.col("o_orderkey") % 4).alias("campeonato"))
    return naming.standard_competition(rows).select("o_orderkey", "campeonato")


@query("p17_club_names", """
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN n_name ELSE c_name END AS clube
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def p17(spark, sf):
    rows = views.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("bigint").alias("clube_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("clube"))
    return naming.standard_club(rows, docs.club_names(spark, sf), "clube_id", "clube").select(
        "c_custkey", "clube")


@query("p18_season_filter", with_(MATCHES, """
SELECT id_jogo, casa, fora FROM matches WHERE temporada = '1997/1998'"""))
def p18(spark, sf):
    return tables.matches_in(views.matches(spark, sf), "1997/1998").select("id_jogo", "casa", "fora")


@query("p19_without_friendlies", with_(MATCHES, """
SELECT id_jogo, campeonato FROM matches WHERE campeonato NOT IN ('Eliminatórias', 'Amistoso')"""))
def p19(spark, sf):
    return tables.without_friendlies(views.matches(spark, sf)).select("id_jogo", "campeonato")


@query("p20_round_numbers", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 38 AS VARCHAR)
  WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 20 AS VARCHAR) ELSE '0' END AS rodada FROM orders""")
def p20(spark, sf):
    e = views.table(spark, sf, "orders").select("o_orderkey", docs.event_struct().alias("e"))
    return e.select("o_orderkey", text.round_number(
        F.col("e.roundInfo.name"), F.col("e.roundInfo.round")).alias("rodada"))


@query("p25_header_tokens", """
SELECT doc_id, length(t) AS tamanho, md5(t) AS resumo FROM (
  SELECT doc_id, regexp_replace(regexp_replace(strip_accents(lower(trim(text || ' Őş Čž'))),
    '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS t
  FROM documents)""")
def p25(spark, sf):
    token = text.header_token(F.concat("text", F.lit(" Őş Čž")))
    return views.table(spark, sf, "documents").select("doc_id", token.alias("t")).select(
        "doc_id", F.length("t").cast("bigint").alias("tamanho"), F.md5("t").alias("resumo"))


@query("p32_age_in_years", with_(PLAYERS, """
SELECT id_jogo, player_id, CAST(floor(date_diff('day', CAST(make_timestamp(birth * 1000000) AS DATE),
  DATE '2020-02-29') / 365.25) AS INTEGER) AS idade FROM player_stats"""))
def p32(spark, sf):
    as_of = F.lit("2020-02-29").cast("date")
    return views.player_stats(spark, sf).select(
        "id_jogo", "player_id",
        labels.age_in_years(F.col("date_of_birth_timestamp"), as_of).alias("idade"))


@query("p33_odds_band", with_(GAMES, """
SELECT id_jogo, clube, CAST(CASE WHEN odd >= 1.01 THEN CASE WHEN odd <= 1.50 THEN 1 WHEN odd <= 2.00 THEN 2
  WHEN odd <= 2.50 THEN 3 WHEN odd <= 3.00 THEN 4 WHEN odd <= 5.00 THEN 5 WHEN odd <= 10.00 THEN 6
  WHEN odd <= 20.00 THEN 7 WHEN odd <= 30.00 THEN 8 WHEN odd <= 40.00 THEN 9 WHEN odd <= 50.00 THEN 10
  ELSE 11 END END AS INTEGER)
  AS ordem FROM games"""))
def p33(spark, sf):
    return club_games(views.matches(spark, sf)).select(
        "id_jogo", "clube", labels.odds_band(F.col("odd"))["ordem"].alias("ordem"))


@query("p34_brazilian_numbers", """
SELECT o_orderkey, '€ ' || translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS valor FROM orders""")
def p34(spark, sf):
    return views.table(spark, sf, "orders").select(
        "o_orderkey", numeric.brazilian_number(F.col("o_totalprice"), 2, "€ ").alias("valor"))


# --- S9 .. S11, S19: CSV ------------------------------------------------------------
@query("s09_matches_csv", with_(MATCHES, """
SELECT id_jogo, CAST(data AS VARCHAR) AS data, hora, casa, fora, gols_casa, gols_fora, temporada,
  CAST(odd_casa AS DOUBLE) AS odd_casa, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS cadastrado_em
FROM matches JOIN orders ON id_jogo = o_orderkey"""))
def s09(spark, sf):
    m = views.matches(spark, sf).withColumn("id", F.col("id_jogo")).withColumn(
        "cadastrado_em", F.date_format("cadastrado_em", "dd/MM/yyyy HH:mm"))
    path = docs.write_csv(m.select(*fixed.MATCH_BACKUP_COLUMNS), "backup", sep=";", header=True)
    return files.read_matches_csv(spark, path, loaded()).select(
        "id_jogo", iso("data"), "hora", "casa", "fora", "gols_casa", "gols_fora", "temporada",
        dbl("odd_casa"), F.date_format("cadastrado_em", "yyyy-MM-dd HH:mm:ss").alias("cadastrado_em"))


@query("s10_goals_csv", with_(GOALS, """
SELECT id_jogo, temporada, campeonato, clube_gol, minutos, forma_gol, placar FROM goals"""))
def s10(spark, sf):
    path = docs.write_csv(views.goals(spark, sf).select(fixed.GOAL_COLUMNS), "goals",
                          sep="|", header=True)
    return files.read_goals_csv(spark, path, loaded_at=loaded()).drop("cadastrado_em")


HISTORY_SQL = with_(MATCHES, """
SELECT CAST(data AS VARCHAR) AS data, campeonato, temporada, casa, coalesce(gols_casa, 0) AS gols_casa,
  coalesce(gols_fora, 0) AS gols_fora, fora FROM matches""")


@query("s11_history_csv_with_header", HISTORY_SQL)
def s11(spark, sf):
    m = views.matches(spark, sf).select(
        F.date_format("data", "dd/MM/yyyy").alias("Date"), F.col("campeonato").alias("Competição"),
        F.col("temporada").alias("Season"), F.col("casa").alias("Time Mandante"),
        F.col("gols_casa").alias("Home Goals"), F.col("gols_fora").alias("Placar Fora"),
        F.col("fora").alias("Visitante"))
    path = docs.write_csv(m, "history", sep=";", header=True)
    return files.read_history_csv(spark, path, loaded_at=loaded()).select(
        iso("data"), "campeonato", "temporada", "casa", "gols_casa", "gols_fora", "fora")


@query("s11_history_csv_without_header", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data, 'Liga' AS campeonato,
  CAST(year(o_orderdate) AS VARCHAR) AS temporada, 'A' || o_custkey AS casa,
  CAST(o_orderkey % 5 AS INTEGER) AS gols_casa,
  CAST(CASE WHEN o_orderkey % 10 = 2 THEN 0 ELSE o_orderkey % 3 END AS INTEGER) AS gols_fora,
  CASE WHEN o_orderkey % 10 <> 1 THEN 'B' END AS fora
FROM orders WHERE o_orderkey % 10 NOT IN (0, 3)""")
def s11_plain(spark, sf):
    k = F.col("o_orderkey")
    cells = [
        F.when(k % 10 == 3, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        F.lit("Liga"), F.year("o_orderdate").cast("string"),
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")), (k % 5).cast("string"),
        F.when(k % 10 == 2, "x").otherwise((k % 3).cast("string")),
        F.when(k % 10 == 0, "B,surplus,field").when(k % 10 == 1, F.lit(None)).otherwise("B"),
    ]
    # concat_ws skips the NULL, so every tenth line is one field short
    path = docs.write_lines(
        views.table(spark, sf, "orders").select(F.concat_ws(",", *cells).alias("value")), "plain")
    return files.read_history_csv(spark, path, loaded_at=loaded()).select(
        iso("data"), "campeonato", "temporada", "casa", "gols_casa", "gols_fora", "fora")


@query("s19_odds_csv", with_(MATCHES, """
SELECT casa, fora, gols_casa, gols_fora, CAST(odd_casa AS DOUBLE) AS odd_casa,
  CAST(odd_empate AS DOUBLE) AS odd_empate, CAST(odd_fora AS DOUBLE) AS odd_fora FROM matches"""))
def s19(spark, sf):
    cols = ["casa", "fora", "gols_casa", "gols_fora", "odd_casa", "odd_empate", "odd_fora"]
    m = views.matches(spark, sf).select(
        [F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(n)
         for c, n in zip(cols, fixed.ODDS_COLUMNS)])
    path = docs.write_csv(m, "odds", header=True)
    return files.read_odds_csv(spark, path).select(
        "casa", "fora", "gols_casa", "gols_fora", dbl("odd_casa"), dbl("odd_empate"), dbl("odd_fora"))


# --- S12 .. S15: documents ------------------------------------------------------------
EVENTS_SQL = f"""
SELECT o_orderkey AS id_jogo, strftime(t, '%Y-%m-%d') AS data, strftime(t, '%H:%M') AS hora,
  CASE o_orderkey % 4 WHEN 0 THEN 'Brasileiro' WHEN 1 THEN 'La Liga' WHEN 2 THEN 'Copa X'
    ELSE 'Liga dos Campeões' END AS campeonato,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 38 AS VARCHAR)
    WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 20 AS VARCHAR) ELSE '0' END AS rodada,
  coalesce(CASE WHEN o_custkey % 25 % 2 = 0 THEN n_name END, 'Club ' || o_custkey) AS casa,
  'Visitor' AS fora,
  CAST(CASE WHEN o_orderkey % 2 = 0 THEN cents % 6 WHEN o_orderkey % 7 <> 0 THEN cents % 5
    ELSE 0 END AS INTEGER) AS gols_casa, CAST(cents % 4 AS INTEGER) AS gols_fora
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
  make_timestamp(({EPOCH_SQL} - 10800) * 1000000) AS t FROM orders)
JOIN nation ON o_custkey % 25 = n_nationkey"""


@query("s12_event_documents", EVENTS_SQL)
def s12(spark, sf):
    return documents.flatten_events(
        docs.event_docs(spark, sf), docs.club_names(spark, sf)
    ).select("id_jogo", iso("data"), "hora", "campeonato", "rodada", "casa", "fora",
             "gols_casa", "gols_fora")


STATS_DOC_SQL = """
SELECT o_orderkey AS id_jogo, periodo, side AS clube, CAST(year(o_orderdate) AS VARCHAR) AS temporada,
  CAST(30 + cents % 41 AS VARCHAR) || '%' AS ball_possession,
  CAST((cents + CASE periodo WHEN '1ST' THEN 1 ELSE 2 END) %
    CASE side WHEN 'Home FC' THEN 9 ELSE 8 END AS INTEGER) AS big_chances,
  CAST(o_orderkey % CASE side WHEN 'Home FC' THEN 5 ELSE 6 END AS INTEGER) AS fouled_in_final_third,
  CAST(NULL AS INTEGER) AS total_shots
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
  (VALUES ('1ST'), ('2ND')) p(periodo), (VALUES ('Home FC'), ('Away FC')) s(side)
WHERE periodo = '1ST' OR o_orderkey % 7 <> 0"""


@query("s13_statistics_documents", STATS_DOC_SQL)
def s13(spark, sf):
    rows = documents.flatten_team_stats(docs.statistics_docs(spark, sf))
    return documents.widen(rows, schemas.TEAM_STATS).select(
        "id_jogo", "periodo", "clube", "temporada", "ball_possession", "big_chances",
        "fouled_in_final_third", "total_shots")


@query("s14_lineup_documents", """
SELECT l_orderkey AS id_jogo, CASE WHEN a < 2 THEN 'Home FC' ELSE 'Away FC' END AS team,
  l_partkey + a AS player_id, 'P' || l_partkey AS name,
  ['G', 'D', 'M', 'F'][l_linenumber % 4 + 1] AS position,
  CAST(l_linenumber + a AS INTEGER) AS jersey_number, CAST(170 + l_linenumber AS INTEGER) AS height,
  'Brazil' AS country, CASE WHEN l_linenumber > 4 THEN 1 ELSE 0 END AS substitute,
  CAST(50 + q % 50 AS DOUBLE) AS rating, CAST(q AS INTEGER) AS minutes_played,
  CAST(q % 3 AS INTEGER) AS goals, CAST(q % 5 AS INTEGER) AS big_chance_created,
  CAST(q % 7 AS INTEGER) AS key_pass
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem), (VALUES (0), (1), (2)) v(a)""")
def s14(spark, sf):
    rows = documents.flatten_lineups(docs.lineup_docs(spark, sf))
    return documents.widen(rows, schemas.PLAYER_STATS).select(
        "id_jogo", "team", "player_id", "name", "position", "jersey_number", "height", "country",
        F.col("substitute").cast("int").alias("substitute"), "rating", "minutes_played", "goals",
        "big_chance_created", "key_pass")


@query("s15_incident_documents", """
SELECT event_id AS id_jogo, ordem, CASE WHEN CASE ordem WHEN 1 THEN event_id % 3 = 0
    ELSE event_id % 2 = 0 END THEN 'Home FC' ELSE 'Away FC' END AS clube_gol,
  CAST(CASE ordem WHEN 1 THEN event_id % 90 ELSE event_id % 70 END AS INTEGER) AS minutos,
  CASE ordem WHEN 1 THEN 'left-foot' ELSE 'right-foot' END AS forma_gol,
  CAST(event_id % 4 AS VARCHAR) || '-' ||
    CASE WHEN event_id % 6 <> 0 THEN CAST(event_id % 3 AS VARCHAR) ELSE '0' END AS placar
FROM events, (VALUES (1), (2)) v(ordem)""")
def s15(spark, sf):
    return documents.flatten_goals(docs.incident_docs(spark, sf)).select(
        "id_jogo", "ordem", "clube_gol", "minutos", "forma_gol", "placar")


# --- S16 .. S18: links ---------------------------------------------------------------
@query("s16_link_list", """
SELECT CASE page_id % 6 WHEN 0 THEN url || '#id:' || page_id ELSE url END AS link,
  CASE page_id % 6 WHEN 0 THEN page_id END AS id_jogo
FROM pages WHERE page_id % 6 IN (0, 1, 3)""")
def s16(spark, sf):
    k, url = F.col("page_id") % 6, F.col("url")
    line = (F.when(k == 0, F.concat(F.lit("'"), url, F.lit("#id:"), F.col("page_id").cast("string"), F.lit("',")))
            .when(k == 1, F.concat(F.lit('  "'), url, F.lit('" ,')))
            .when(k == 2, F.concat(F.lit("# "), url))
            .when(k == 3, url)
            .when(k == 4, F.concat(F.lit("ftp://x/"), F.col("page_id").cast("string")))
            .otherwise(""))
    path = docs.write_lines(views.table(spark, sf, "pages").select(line.alias("value")), "links")
    return files.read_links(spark, path).select("link", "id_jogo")


@query("s17_links_with_match_id", """
SELECT page_id, url || '#id:' || page_id AS link, page_id AS id_jogo FROM pages WHERE page_id % 2 = 0""")
def s17(spark, sf):
    k, url = F.col("page_id"), F.col("url")
    link = F.when(k % 2 == 0, F.concat(url, F.lit("#id:"), k.cast("string"))).otherwise(url)
    return files.match_links(views.table(spark, sf, "pages").select("page_id", link.alias("link")))


@query("s18_filtered_links", """
SELECT url AS link, min(page_id) AS posicao FROM pages
WHERE contains(lower(url), 'example.net') AND NOT starts_with(url, 'http://blog.')
  AND NOT starts_with(url, 'chrome://') AND page_id % 5 <> 0 GROUP BY url""")
def s18(spark, sf):
    label = F.when(F.col("page_id") % 5 == 0, "Jogo ADIÁDO").otherwise("Jogo")
    links = views.table(spark, sf, "pages").select(
        F.col("page_id").alias("posicao"), F.col("url").alias("link"), label.alias("rotulo"))
    return files.filter_links(links, "Example.net", ["http://blog."], label="rotulo")


# --- K: sinks ------------------------------------------------------------------------
STORED = "data < DATE '1999-01-01'"
INCOMING = "data >= DATE '1998-01-01'"


def parts(spark, sf):
    m = views.matches(spark, sf).drop("_cents")
    return m.filter(STORED), m.filter(INCOMING)


@query("k01_new_matches", with_(MATCHES, """
SELECT id_jogo, casa, fora FROM matches WHERE data >= DATE '1999-01-01'"""))
def k01(spark, sf):
    """Every match is delivered twice, once without its clubs."""
    stored, incoming = parts(spark, sf)
    bare = incoming.withColumns({c: F.lit(None).cast("string") for c in ("casa", "fora")})
    return sinks.new_rows(incoming.unionByName(bare), stored).select("id_jogo", "casa", "fora")


@query("k02_fill_blanks", with_(MATCHES, """
SELECT id_jogo, CASE WHEN pais <> 'Mundo' THEN pais
    WHEN data >= DATE '1998-01-01' AND id_jogo % 2 = 0 THEN 'Brasil' ELSE '' END AS pais,
  CAST(coalesce(odd_casa, CASE WHEN data >= DATE '1998-01-01' THEN 1.5 ELSE 0 END) AS DOUBLE) AS odd_casa,
  campeonato FROM matches WHERE data < DATE '1999-01-01'"""))
def k02(spark, sf):
    stored, incoming = parts(spark, sf)
    stored = stored.withColumn("pais", F.when(F.col("pais") == "Mundo", "").otherwise(F.col("pais")))
    incoming = incoming.withColumns({
        "pais": F.when(F.col("id_jogo") % 2 == 0, "Brasil").otherwise(fixed.UNKNOWN_COUNTRY),
        "odd_casa": F.lit("1.5").cast("decimal(8,2)"), "campeonato": F.lit("Outro")})
    # Stored odds of 0 are blank, incoming ones fill nothing, and repeated ids do not multiply rows.
    stored = stored.withColumn("odd_casa", F.coalesce("odd_casa", F.lit(0).cast("decimal(8,2)")))
    zero = incoming.withColumn("odd_casa", F.lit(0).cast("decimal(8,2)"))
    incoming = incoming.unionByName(zero)
    return sinks.fill_blanks(stored, incoming).select(
        "id_jogo", "pais", dbl("odd_casa"), "campeonato")


@query("k03_upsert", with_(MATCHES, """
SELECT id_jogo, CASE WHEN data >= DATE '1998-01-01' THEN 'novo' ELSE 'antigo' END AS origem,
  CAST(CASE WHEN data >= DATE '1998-01-01' THEN 9 ELSE gols_casa END AS INTEGER) AS gols_casa
FROM matches"""))
def k03(spark, sf):
    stored, incoming = parts(spark, sf)
    old = stored.select("id_jogo", F.lit("antigo").alias("origem"), "gols_casa")
    new = incoming.select("id_jogo", F.lit("novo").alias("origem"), F.lit(9).alias("gols_casa"))
    repeated = new.unionByName(new.withColumn("origem", F.lit("zz")))
    return sinks.upsert(old, repeated, order=[F.col("origem").asc()])


@query("k04_insert_ignore", with_(MATCHES + """,
h AS (SELECT *, row_number() OVER (PARTITION BY temporada, casa, fora, gols_casa, gols_fora
  ORDER BY id_jogo) rn FROM matches WHERE gols_casa IS NOT NULL AND gols_fora IS NOT NULL
  AND data >= DATE '1998-01-01')""", """
SELECT temporada, casa, fora, gols_casa, gols_fora, id_jogo FROM h WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM matches m WHERE m.data < DATE '1999-01-01' AND m.temporada = h.temporada
  AND m.casa = h.casa AND m.fora = h.fora AND m.gols_casa = h.gols_casa AND m.gols_fora = h.gols_fora)"""))
def k04(spark, sf):
    stored, incoming = parts(spark, sf)
    key = ["temporada", "casa", "fora", "gols_casa", "gols_fora"]
    known = incoming.filter(labels.is_played())
    return sinks.insert_ignore(known, stored, key, [F.col("id_jogo")]).select(*key, "id_jogo")


@query("k05_append_with_count", with_(MATCHES, """
SELECT count(*) AS linhas, count(*) AS gravadas,
  CAST(count(*) FILTER (WHERE data >= DATE '1999-01-01') AS BIGINT) AS novas FROM matches"""))
def k05(spark, sf):
    stored, incoming = parts(spark, sf)
    path = shared_dir(spark, "append")
    first = sinks.insert_new(stored, path)  # into a table that is not there yet
    second = sinks.insert_new(incoming.unionByName(incoming), path)
    counts = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("linhas"))
    return counts.select("linhas", F.lit(first + second).cast("bigint").alias("gravadas"),
                         F.lit(second).cast("bigint").alias("novas"))


@query("k06_align_to_schema", with_(STATS, """
SELECT id_jogo, periodo, clube, total_shots, CAST(NULL AS INTEGER) AS red_cards, 0 AS passes
FROM team_stats"""))
def k06(spark, sf):
    partial = views.team_stats(spark, sf).select(
        "total_shots", "clube", "periodo", "id_jogo", F.lit("x").alias("surplus"))
    return sinks.align(partial, schemas.TEAM_STATS, {"passes": F.lit(0)}).select(
        "id_jogo", "periodo", "clube", "total_shots", "red_cards", "passes")


@query("k07_saved_report", with_(GAMES, f"""
SELECT clube, {half_up('sum(pontos)', 'count(*)')} AS pontuacao FROM games GROUP BY clube"""))
def k07(spark, sf):
    folder = shared_dir(spark, "reports")
    table = results.points_per_game(club_games(views.matches(spark, sf)))
    sinks.save_reports({"pontos_por_jogo": table}, folder)
    sinks.save_reports({"pontos_por_jogo": table}, folder)
    return spark.read.parquet(f"{folder}/pontos_por_jogo")


@query("k08_goal_export", with_(GOALS, """
SELECT id_jogo, clube_gol, minutos, placar FROM goals"""))
def k08(spark, sf):
    path = shared_dir(spark, "export")
    sinks.export_goals(views.goals(spark, sf), path)
    return spark.read.schema(
        "id_jogo BIGINT, temporada STRING, campeonato STRING, clube_gol STRING, minutos INT, "
        "forma_gol STRING, placar STRING, ordem BIGINT").option("header", True).csv(path).select(
        "id_jogo", "clube_gol", "minutos", "placar")


# --- X1 / X2 --------------------------------------------------------------------------
def _landed(spark, sf, where, odds):
    o = views.table(spark, sf, "orders").filter(where)
    k = F.col("o_orderkey")
    return o.select(
        docs.event_struct().alias("evento"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, fixed.UNKNOWN_COUNTRY).otherwise("Brasil").alias("pais"),
        F.lit("2025").alias("temporada"), F.lit(odds).alias("odd_casa"),
        F.when(k % 2 == 0, odds).alias("odd_empate"), F.lit(None).cast("double").alias("odd_fora"))


@query("x01_incremental_match_load", f"""
SELECT e.*, CASE WHEN id_jogo % 3 = 1 THEN 'Desconhecido' WHEN id_jogo % 3 = 2 THEN 'Brasil' END AS pais,
  CASE WHEN NOT late THEN 1.5 ELSE 2.5 END::DOUBLE AS odd_casa,
  CASE WHEN id_jogo % 2 = 0 THEN CASE WHEN NOT late THEN 1.5 ELSE 2.5 END END::DOUBLE AS odd_empate,
  (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0) AS rejeitadas
FROM ({EVENTS_SQL}) e JOIN (SELECT o_orderkey, o_orderdate >= TIMESTAMP '1999-01-01' AS late FROM orders)
  ON id_jogo = o_orderkey""")
def x01(spark, sf):
    """Two sources into one log that overlap in 1998, the second with broken lines; then the
    first again under a new checkpoint. Nothing stored is lost, nothing comes twice."""
    log = shared_dir(spark, "log")
    clubs = docs.club_names(spark, sf)
    first = _landed(spark, sf, F.col("o_orderdate") < "1999-01-01", 1.5)
    second = _landed(spark, sf, F.col("o_orderdate") >= "1998-01-01", 2.5)
    broken = views.table(spark, sf, "orders").filter(F.col("o_orderkey") % 50 == 0).select(
        F.concat(F.lit('{"evento": {"id": '), F.col("o_orderkey").cast("string")).alias("value"))
    places = [shared_dir(spark, "landing") for _ in range(2)]
    first.write.json(places[0])
    second.write.json(places[1])
    broken.write.mode("append").text(places[1])
    for where in (places[0], places[1], places[0]):
        incremental.load_events(spark, where, log, shared_dir(spark, "state"), clubs).awaitTermination()
    rejected = spark.read.parquet(incremental.rejected_dir(log)).agg(F.count(F.lit(1)).alias("rejeitadas"))
    return incremental.current_matches(incremental.read_log(spark, log)).crossJoin(F.broadcast(rejected)).select(
        "id_jogo", iso("data"), "hora", "campeonato", "rodada", "casa", "fora", "gols_casa",
        "gols_fora", "pais", dbl("odd_casa"), dbl("odd_empate"), "rejeitadas")


@query("x02_no_duplicates_across_loads", with_(MATCHES, """
SELECT id_jogo, CAST(data AS VARCHAR) AS data, casa, fora, gols_casa,
  CAST(odd_casa AS DOUBLE) AS odd_casa FROM matches"""))
def x02(spark, sf):
    """The same CSV delivery landed twice, in separate loads and within one load, there with
    copies that lack date and goals."""
    landing, log, state = (shared_dir(spark, n) for n in ("landing", "log", "state"))
    rows = views.matches(spark, sf).select(*[f.name for f in schemas.MATCHES.fields])
    bare = rows.withColumns({"data": F.lit(None).cast("date"), "gols_casa": F.lit(None).cast("int")})
    for delivery in (rows.unionByName(bare), rows):
        delivery.write.mode("append").option("header", True).csv(landing)
        incremental.load_match_csv(spark, landing, log, state).awaitTermination()
    return incremental.current_matches(incremental.read_log(spark, log)).select(
        "id_jogo", iso("data"), "casa", "fora", "gols_casa", dbl("odd_casa"))


#: Lines of a landed file: it is compressed, so one task reads it, about as much text as a split has.
LANDED_LINES = 100_000


def _twice(spark, load, documents_, schema):
    """Load the documents, land them all again, and load under the same and a new checkpoint.

    The three landed copies lie beside each other until the end, so they are compressed.
    """
    landing, log, state = (shared_dir(spark, n) for n in ("landing", "log", "state"))
    lines = documents_.withColumn("campeonato", F.lit("Copa")) if "campeonato" not in documents_.columns else documents_
    for where in (state, state, shared_dir(spark, "state")):
        lines.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LANDED_LINES).json(landing)
        load(spark, landing, log, where).awaitTermination()
    return incremental.read_log(spark, log, schema)


@query("x03_incremental_statistics", STATS_DOC_SQL)
def x03(spark, sf):
    rows = _twice(spark, incremental.load_statistics, docs.statistics_docs(spark, sf), incremental.STATISTICS)
    return documents.widen(rows, schemas.TEAM_STATS).select(
        "id_jogo", "periodo", "clube", "temporada", "ball_possession", "big_chances",
        "fouled_in_final_third", "total_shots")


@query("x04_incremental_lineups", """
SELECT l_orderkey AS id_jogo, CASE WHEN a < 2 THEN 'Home FC' ELSE 'Away FC' END AS team,
  l_partkey + a AS player_id, CAST(q AS INTEGER) AS minutes_played, CAST(q % 7 AS INTEGER) AS key_pass
FROM (SELECT l_orderkey, max(l_partkey) AS l_partkey, CAST(max(l_quantity) AS BIGINT) AS q
  FROM lineitem GROUP BY l_orderkey), (VALUES (0), (1), (2)) v(a)""")
def x04(spark, sf):
    lines = views.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        *[F.max(c).alias(c) for c in ("l_partkey", "l_linenumber", "l_quantity")])
    one = docs.lineup_docs(spark, sf, lines)
    return _twice(spark, incremental.load_lineups, one, schemas.PLAYER_STATS).select(
        "id_jogo", "team", "player_id", "minutes_played", "key_pass")


@query("x05_incremental_goals", """
SELECT event_id AS id_jogo, CASE WHEN CASE ordem WHEN 1 THEN event_id % 3 = 0
    ELSE event_id % 2 = 0 END THEN 'Home FC' ELSE 'Away FC' END AS clube_gol,
  CAST(CASE ordem WHEN 1 THEN event_id % 90 ELSE event_id % 70 END AS INTEGER) AS minutos
FROM events, (VALUES (1), (2)) v(ordem)""")
def x05(spark, sf):
    return _twice(spark, incremental.load_goals, docs.incident_docs(spark, sf), schemas.GOALS).select(
        "id_jogo", "clube_gol", "minutos")
