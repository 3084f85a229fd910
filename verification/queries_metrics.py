"""Registered queries over metrics that no schema declares."""

from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.sources import metrics
from verification import docs, views
from verification.registry import query, with_

KEYS = ["id_jogo", "temporada", "periodo", "clube"]

# Items by label: numbers sent as numbers, as text, with decimals, percentages, and a second
# value of one metric under another spelling of its label, which stays.
ITEMS = """
base AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
periods AS (SELECT *, 'ALL' AS periodo FROM base UNION ALL SELECT *, '1ST' FROM base WHERE k % 7 <> 0),
sides AS (SELECT *, 'Home FC' AS clube, 0 AS lado FROM periods UNION ALL SELECT *, 'Away FC', 1 FROM periods),
items AS (
  SELECT k AS id_jogo, periodo, clube, 'Total shots' AS rotulo, 'total_shots' AS metrica,
    CAST((c + lado) % 23 AS VARCHAR) AS valor FROM sides
  UNION ALL SELECT k, periodo, clube, 'Ball possession', 'ball_possession', CAST(30 + c % 41 AS VARCHAR) || '%' FROM sides
  UNION ALL SELECT k, periodo, clube, 'Big chances', 'big_chances', CAST(c % 5 AS VARCHAR) || '.5' FROM sides WHERE k % 50 = 0
  UNION ALL SELECT k, periodo, clube, 'VAR checks', 'var_checks', CAST((k + lado) % 3 AS VARCHAR) FROM sides WHERE k % 10 = 0
  UNION ALL SELECT k, periodo, clube, 'Expected assists', 'expected_assists', '0.' || CAST(10 + k % 90 AS VARCHAR) FROM sides WHERE k % 4 = 0
  UNION ALL SELECT k, periodo, clube, 'expected (assists)', 'expected_assists', '1.' || CAST(10 + k % 90 AS VARCHAR) FROM sides WHERE k % 12 = 0
)"""


def team_docs(spark, sf):
    o = views.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    c = F.round(F.col("o_totalprice") * 100).cast("bigint")

    def item(label, home, away, quoted=True, when=None):
        q = '"' if quoted else ""
        text = F.format_string(f'{{"name":"{label}","home":{q}%s{q},"away":{q}%s{q}}}', home.cast("string"), away.cast("string"))
        return text if when is None else F.when(when, text)

    share = F.concat((30 + c % 41).cast("string"), F.lit("%"))
    decimals = lambda first: F.concat(F.lit(f"{first}."), (10 + k % 90).cast("string"))
    half = F.concat((c % 5).cast("string"), F.lit(".5"))
    items = F.concat_ws(
        ",", item("Total shots", c % 23, (c + 1) % 23), item("Ball possession", share, share),
        item("Big chances", half, half, False, k % 50 == 0), item("VAR checks", k % 3, (k + 1) % 3, False, k % 10 == 0),
        item("Expected assists", decimals(0), decimals(0), True, k % 4 == 0),
        item("expected (assists)", decimals(1), decimals(1), True, k % 12 == 0))
    period = lambda code: F.concat(
        F.lit(f'{{"period":"{code}","groups":[{{"statisticsItems":['), items, F.lit("]}]}"))
    both = F.concat_ws(",", period("ALL"), F.when(k % 7 != 0, period("1ST")))
    return o.select(
        k.alias("id_jogo"), F.lit("Home FC").alias("casa"), F.lit("Away FC").alias("fora"), F.lit("2025").alias("temporada"),
        F.concat(F.lit('{"statistics":['), both, F.lit("]}")).alias("doc"))


def team_rows(spark, sf):
    return metrics.team_metrics(metrics.bronze(team_docs(spark, sf)))


@query("m01_metrics_of_bronze_documents", with_(ITEMS, """
SELECT id_jogo, periodo, clube, rotulo, metrica, valor FROM items"""))
def m01(spark, sf):
    return team_rows(spark, sf).select("id_jogo", "periodo", "clube", "rotulo", "metrica", metrics.plain(F.col("valor")).alias("valor"))


# Every column of the wide schema that the documents never have.
_SENT = ("total_shots", "ball_possession", "big_chances")
_ABSENT = ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in schemas.TEAM_STATS.fields if f.name not in (*KEYS, *_SENT))


@query("m02_labels_against_the_schema", with_(ITEMS, f"""
SELECT metrica, string_agg(DISTINCT rotulo, '|' ORDER BY rotulo) AS rotulos, count(*) AS linhas,
  CASE metrica WHEN 'ball_possession' THEN 'string' WHEN 'total_shots' THEN 'int' WHEN 'var_checks' THEN 'int' ELSE 'double' END AS tipo,
  CASE WHEN metrica IN {_SENT} THEN 'declarada' ELSE 'nova' END AS situacao,
  CASE WHEN metrica IN {_SENT} THEN metrica <> 'big_chances' END AS cabe
FROM items GROUP BY metrica
UNION ALL SELECT v.m, NULL, 0, NULL, 'ausente', NULL FROM (VALUES {_ABSENT}) v(m, t)"""))
def m02(spark, sf):
    found = metrics.against(metrics.catalogue(team_rows(spark, sf)), schemas.TEAM_STATS, KEYS)
    return found.select("metrica", F.when(F.col("rotulos").isNotNull(), F.concat_ws("|", "rotulos")).alias("rotulos"),
                        "linhas", "tipo", "situacao", "cabe")


@query("m03_schema_widened_on_request", with_(ITEMS, """
SELECT id_jogo, periodo, clube,
  CAST(max(valor) FILTER (WHERE metrica = 'total_shots') AS INTEGER) AS total_shots,
  CAST(floor(CAST(max(valor) FILTER (WHERE metrica = 'big_chances') AS DOUBLE)) AS INTEGER) AS big_chances,
  CAST(max(valor) FILTER (WHERE metrica = 'var_checks') AS INTEGER) AS var_checks,
  CAST(max(valor) FILTER (WHERE metrica = 'expected_assists') AS DOUBLE) AS expected_assists
FROM items GROUP BY ALL"""))
def m03(spark, sf):
    rows = team_rows(spark, sf)
    schema = metrics.widened(schemas.TEAM_STATS, metrics.catalogue(rows), ["var_checks", "expected_assists"])
    return metrics.wide(rows, schema, KEYS).select(
        "id_jogo", "periodo", "clube", "total_shots", "big_chances", "var_checks", "expected_assists")


@query("m04_labels_of_lineup_documents", """
SELECT m.metrica, m.rotulos, CAST(3 * m.times * (SELECT count(*) FROM lineitem) AS BIGINT) AS linhas, m.tipo
FROM (VALUES ('minutes_played', 'minutesPlayed', 1, 'int'), ('goals', 'goals', 1, 'int'),
  ('big_chance_created', 'bigChanceCreated', 1, 'int'), ('key_pass', 'keyPass|key_pass', 2, 'int')) m(metrica, rotulos, times, tipo)""")
def m04(spark, sf):
    rows = metrics.player_metrics(metrics.bronze(docs.lineup_docs(spark, sf)))
    return metrics.catalogue(rows).select("metrica", F.concat_ws("|", "rotulos").alias("rotulos"), "linhas", "tipo")
