"""The five report sets on the fixture, and the plans that season scopes get."""

import datetime

import pytest
from pyspark.sql import functions as F

from builders import match
from pitchlake import schemas
from pitchlake.operators import club_games as cg
from pitchlake.operators import streaks
from pitchlake.plans import reports
from pitchlake.sources import tables
from test_teams_players import player, stat


@pytest.fixture(scope="module")
def team_stats(spark):
    values = {"total_shots": 10, "shots_on_target": 4, "passes": 100, "accurate_passes": 80, "big_chances": 3,
              "big_chances_scored": 1, "expected_goals": 1.5, "ball_possession": "50%", "duels": "50%", "red_cards": 1}
    data = [stat(i, p, c, **values) for i, c1, c2 in ((1, "A", "B"), (2, "B", "A"), (3, "A", "C"), (4, "C", "A"))
            for p in ("1ST", "2ND", "ALL") for c in (c1, c2)]
    return spark.createDataFrame(data, schemas.TEAM_STATS)


@pytest.fixture(scope="module")
def player_stats(spark):
    data = [player(i, t, pid, f"P{pid}", pos, goals=1, goal_assist=1, rating=7.0, expected_goals=2.0, touches=50, key_pass=2,
                   big_chance_created=1, height=180)
            for i in (1, 2) for t, base in (("A", 0), ("B", 100)) for pid, pos in ((base + k, "GDMF"[k % 4]) for k in range(12))]
    return spark.createDataFrame(data, schemas.PLAYER_STATS)


def collected(sets):
    return {name: [r.asDict() for r in df.collect()] for name, df in sets.items()}


def test_duel_set(matches, team_stats, player_stats):
    got = collected(reports.duel_report(matches, team_stats, player_stats, "A", "B", "2025"))
    assert len(got) >= 25 and {r["periodo"] for r in got["primeiro_tempo"]} == {"1ST"}
    assert {(r["placar"], r["qtd"]) for r in got["placares_confronto"]} == {("4-0", 1)}
    assert {(r["casa"], r["placar"]) for r in got["placares_confronto_geral"]} == {("A", "4-0"), ("A", "1-1")}
    assert got["formacao"] and got["escalacao_provavel"] and got["jogo_completo"]


def test_club_set(matches, team_stats, player_stats):
    got = collected(reports.club_report(matches, team_stats, player_stats, "A", "2025"))
    (card,) = got["desempenho_temporada"]
    assert card["jogos"] == 5 and got["estatisticas"] and got["como_mandante"]


def test_profile_set(matches, team_stats, player_stats):
    got = collected(reports.profile_report(matches, team_stats, player_stats, "A", "B", "2025", datetime.date(2025, 6, 1)))
    assert all(got[n] for n in ("chances", "ataque", "posse", "defesa", "duelos", "jogadores_minutos", "idade_e_valor"))
    assert {r["clube_analise"] for r in got["ataque"]} == {"A", "B"}


def test_monthly_set(matches, team_stats, player_stats):
    got = collected(reports.monthly_report(matches, team_stats, player_stats, "2025-02-10"))
    assert [r["posicao"] for r in got["classificacao"]] == list(range(1, len(got["classificacao"]) + 1))
    assert got["classificacao"][0]["clube"] and got["jogadores_gols"][0]["valor"] == 2 and got["faixas_de_odds"]


def test_competition_set(matches, team_stats, player_stats):
    got = collected(reports.competition_report(matches, team_stats, player_stats, "2025", "Liga", "Brasil"))
    assert all(got[n] for n in ("desempenho", "vitorias", "ppj_geral", "invencibilidade", "medias", "jogadores_minutos"))
    assert got["jogadores_gols"][0]["valor"] == 2


def test_season_filter_prunes_the_statistics(spark, matches, team_stats, player_stats, tmp_path):
    for name, df in (("m", matches), ("t", team_stats), ("p", player_stats)):
        df.write.partitionBy("temporada").parquet(str(tmp_path / name))
    m, t, p = (spark.read.schema(s).parquet(str(tmp_path / n)) for n, s in (
        ("m", schemas.MATCHES), ("t", schemas.TEAM_STATS), ("p", schemas.PLAYER_STATS)))
    season = tables.matches_in(m, "2025")
    for scope in (tables.team_stats_of(t, season, seasons=["2025"]), tables.player_stats_of(p, season, seasons=["2025"])):
        plan = scope._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(temporada" in plan and plan.count("= 2025)") >= 2, plan


def test_runs_of_a_club_with_most_of_the_games(spark):
    day = datetime.date(2020, 1, 1)
    data = [match(i, str(day + datetime.timedelta(days=i)), "Hot", f"C{i % 7}", int(i % 50 != 7), 0) for i in range(400)]
    data += [match(1000 + i, "2021-05-05", f"C{i}", f"D{i}", 1, 0) for i in range(20)]
    games = cg.club_games(spark.createDataFrame(data, schemas.MATCHES))
    hot = streaks.runs(games, streaks.WINNING).filter("clube = 'Hot'").first()
    assert (hot.maior, hot.atual) == (49, 42)


def test_rank_with_one_share_held_by_most(spark):
    df = spark.range(1000).select(F.format_string("%04d", "id").alias("clube"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(50.0)
                                  .cast("double").alias("share"))
    got = cg.rank_all(df, "share", [F.col("clube")]).collect()
    want = sorted(got, key=lambda r: (-r.share, r.clube))
    assert [r.posicao for r in want] == list(range(1, 1001))
