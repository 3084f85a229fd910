import datetime

import pytest
from pyspark.sql import functions as F

from builders import match, rows
from pitchlake import schemas
from pitchlake.functions import labels
from pitchlake.operators import players as pl
from pitchlake.operators import team_stats as ts
from pitchlake.sources import tables

STAT_NAMES = [f.name for f in schemas.TEAM_STATS.fields]
PLAYER_NAMES = [f.name for f in schemas.PLAYER_STATS.fields]


def stat(id_, periodo, clube, **values):
    base = {"id_jogo": id_, "periodo": periodo, "clube": clube, "temporada": "2025"}
    return tuple((base | values).get(n) for n in STAT_NAMES)


def player(id_, team, pid, name="P", position="M", minutes=90, **values):
    base = {"id_jogo": id_, "team": team, "player_id": pid, "name": name, "position": position,
            "minutes_played": minutes, "substitute": False, "temporada": "2025"}
    return tuple((base | values).get(n) for n in PLAYER_NAMES)


@pytest.fixture(scope="module")
def stats(spark):
    data = [
        stat(1, "ALL", "A", ball_possession="60%", expected_goals=2.0, big_chances=4,
             big_chances_scored=2, total_shots=10, shots_on_target=5, passes=400, tackles=10,
             interceptions=5, recoveries=20, clearances=5, crosses="5/16 (31%)", duels="50%"),
        stat(1, "ALL", "B", ball_possession="40%", expected_goals=0.5, big_chances=0,
             big_chances_scored=0, total_shots=0, shots_on_target=0, passes=200, tackles=8),
        # the opponent's row of match 2 is missing
        stat(2, "ALL", "A", ball_possession="n/d", expected_goals=None, big_chances=2,
             big_chances_scored=0, total_shots=6, shots_on_target=1, passes=300, tackles=2,
             crosses="0/0 (0%)"),
        stat(1, "1ST", "A", ball_possession="55,5%", red_cards=1, yellow_cards=2),
        stat(1, "2ND", "A", ball_possession="65%", red_cards=1, yellow_cards=1),
        stat(1, "1ST", "B", ball_possession="44,5%", red_cards=2),
    ]
    return spark.createDataFrame(data, schemas.TEAM_STATS)


def test_period_card_adds_red_cards_of_both_halves(stats, matches):
    card = rows(ts.period_card(tables.team_stats_of(stats, matches)), "periodo", "clube")
    a = card[("ALL", "A")]
    assert (a.jogos, a.posse_bola, a.xg_medio, a.xg_total, a.vermelhos) == (2, 60.0, 2.0, 2.0, 2)
    assert (a.grandes_chances_jogo, a.aproveitamento_grandes_chances) == (3.0, 33.33)
    assert (a.finalizacoes_jogo, a.acerto_finalizacoes) == (8.0, 37.5)
    assert card[("1ST", "A")].vermelhos == 1 and card[("1ST", "A")].posse_bola == 55.5
    assert card[("ALL", "B")].vermelhos == 2       # cards in the first half only
    assert card[("ALL", "B")].acerto_finalizacoes == 0.0


def test_period_card_keeps_the_last_games_only(stats, matches):
    card = rows(ts.period_card(tables.team_stats_of(stats, matches), 1), "periodo", "clube")
    assert card[("ALL", "A")].passes == 300


def test_context_has_side_and_opponent(stats, matches):
    r = rows(tables.team_stats_of(stats, matches, "ALL"), "id_jogo", "clube")
    assert (r[(2, "A")].mando, r[(2, "A")].adversario) == ("Fora", "B")


def test_leaderboards(stats, matches):
    full = tables.team_stats_of(stats, matches, "ALL")
    board = rows(ts.leaderboard(full, ["passes", "total_shots"], by=()), "metrica", "posicao")
    assert (board[("passes", 1)].clube, board[("passes", 1)].valor) == ("A", 700.0)
    assert board[("total_shots", 2)].valor == 0.0
    assert ts.leaderboard(full, ["passes"], "mean", min_games=2, by=()).count() == 1
    low = ts.leaderboard(full, ["expected_goals"], "mean", k=1, by=(), largest=False).first()
    assert (low.clube, low.valor) == ("B", 0.5)
    with pytest.raises(ValueError):
        ts.leaderboard(full, ["passes"], "median")


def test_ratio_board_skips_zero_over_zero(stats, matches):
    full = tables.team_stats_of(stats, matches, "ALL")
    board = rows(ts.ratio_leaderboard(full), "metrica", "clube")
    assert board[("finalizacoes", "A")].valor == 33.34      # (50.00 + 16.67) / 2, rounded up
    assert ("finalizacoes", "B") not in board


def test_red_card_list_needs_more_than_one(stats):
    got = rows(ts.red_card_leaders(stats), "periodo", "clube")
    assert set(got) == {("1ST", "B"), ("ALL", "A"), ("ALL", "B")}


def test_profiles_do_not_count_a_missing_opponent_as_zero(stats, matches):
    faced = ts.faced(stats, tables.matches_in(matches, "2025"), 10)
    a = rows(ts.chances_profile(faced), "clube_analise")["A"]
    assert (a.jogos, a.xg_favor, a.xg_contra, a.saldo_xg) == (2, 2.0, 0.5, 1.5)
    assert (a.conversao_favor, a.conversao_contra) == (33.33, None)
    assert a.gols_marcados_jogo == 2.5
    press = rows(ts.pressing_index(faced), "clube_analise")["A"]
    assert press.indice_pressao == 4.76            # 200 / (40 + 2)
    attack = rows(ts.attack_profile(faced), "clube_analise")["A"]
    assert attack.acuracia_cruzamentos == 31.25     # 0/0 is no observation
    assert attack.xg_por_chute_favor == 0.2         # the game without xG is left out
    b = rows(ts.chances_profile(faced), "clube_analise")["B"]
    assert b.xg_contra == 2.0                        # the mutual match is seen from both clubs


@pytest.fixture(scope="module")
def squad(spark, matches):
    data = [
        player(1, "A", 1, "Ana", "G", 90, goals=0, goal_assist=1, rating=7.0),
        player(1, "A", 2, "Bia", "D", 89, goals=1, rating=None),
        player(1, "A", 3, "Bia", "D", 90, goals=1, rating=8.0),         # a namesake
        player(1, "A", 4, "Cid", "Z", 10, goals=None, goal_assist=None, substitute=True),
        player(2, "A", 1, "Ana", "G", 90, goals=0, goal_assist=0, rating=6.5),
        player(2, "B", 5, "Dee", "F", 45, goals=2, fouls=3),
        player(9, "C", 5, "Dee", "F", 60, goals=1, fouls=1),            # moved to another club
        player(9, "C", 6, "Eva", "M", 0, goals=9),                      # never on the pitch
    ]
    return tables.player_stats_of(spark.createDataFrame(data, schemas.PLAYER_STATS), matches)


def test_scan_drops_unused_players_and_names_positions(squad):
    got = rows(squad, "player_id", "team")
    assert (6, "C") not in got
    assert got[(4, "A")].position == "Verificar"


def test_leaders_break_ties_by_name_then_id(squad):
    goals = pl.leaders(pl.totals(squad, "goals"), above=0).collect()
    assert [(r.player_id, r.team, r.valor) for r in goals] == [
        (5, "B", 2), (2, "A", 1), (3, "A", 1), (5, "C", 1)]


def test_involvement_treats_missing_as_zero(squad):
    got = rows(pl.totals(squad, "participacao"), "player_id", "team")
    assert got[(4, "A")].valor == 0 and got[(1, "A")].valor == 1


def test_mean_rating_needs_minutes(squad):
    table = pl.totals(squad, "rating", "mean", with_minutes=True)
    got = pl.leaders(table, min_minutes=90).collect()
    assert [(r.player_id, r.valor) for r in got] == [(3, 8.0), (1, 6.75)]


def test_teams_of_a_mover_are_listed_once(squad):
    got = rows(pl.with_teams(squad, "goals"), "player_id")
    assert (got[5].team, got[5].valor) == ("B, C", 3)


def test_recent_games_are_per_team(squad):
    recent = pl.in_recent_games(squad, 1)
    assert {(r.team, r.id_jogo) for r in recent.collect()} == {("A", 2), ("B", 2), ("C", 9)}


def test_regulars_need_a_share_of_the_most_minutes(squad):
    got = rows(pl.regulars(squad, "rating"), "player_id", "team")
    assert set(got) == {(1, "A"), (2, "A"), (3, "A")}      # 40% of 180 minutes is 72


def test_lineup_and_formation(squad):
    lineup = pl.probable_lineup(squad)
    a = lineup.filter("team = 'A'").orderBy("ordem", "player_id").collect()
    assert [(r.player_id, r.jogos_titular) for r in a] == [(1, 2), (2, 1), (3, 1)]
    assert rows(pl.formation(lineup), "team")["A"].formacao == "2-0-0"


def test_formation_leaves_the_goalkeeper_out(spark):
    names = ["Goleiro"] + ["Defensor"] * 4 + ["Meio-campo"] * 6
    df = spark.createDataFrame([("T", n) for n in names], "team string, position string")
    assert pl.formation(df).first().formacao == "4-6-0"


def test_squad_age_uses_the_most_used_players(spark, matches):
    births = [datetime.date(2000, 1, 1), datetime.date(1990, 1, 1), datetime.date(1900, 1, 1)]
    data = [
        player(1, "A", i, f"P{i}", "M", 90 - i, value=i * 10,
               date_of_birth_timestamp=(b - datetime.date(1970, 1, 1)).days * 86400)
        for i, b in enumerate(births)
    ]
    for i, row in enumerate(data):
        data[i] = tuple(
            __import__("decimal").Decimal(v) if n == "value" else v
            for n, v in zip(PLAYER_NAMES, row))
    df = tables.player_stats_of(spark.createDataFrame(data, schemas.PLAYER_STATS), matches)
    got = pl.squad_age_and_value(df, "2025-01-02", size=2).first()
    assert (got.idade_media, got.valor_medio) == (30.0, 5.0)


def test_discipline_divides_by_games_present(squad):
    got = rows(ts.player_discipline(squad, ("team",)), "team")
    assert (got["A"].jogos, got["B"].faltas_jogo) == (2, 3.0)


def test_goals_by_interval(spark):
    df = spark.createDataFrame(
        [("A", 0), ("A", 14), ("A", 15), ("A", 90), ("A", None)], "clube_gol string, minutos int")
    got = rows(pl.goals_by_interval(df), "inicio")
    assert {k: (r.gols, r.perc) for k, r in got.items()} == {
        0: (2, 50.0), 15: (1, 25.0), 90: (1, 25.0)}


def test_hot_team_does_not_lose_rows(spark):
    """One team with most of the rows still gives exactly its last ten games."""
    start = datetime.date(2024, 1, 1)
    games = [match(i, str(start + datetime.timedelta(i)), "HOT", "X", 1, 0) for i in range(100)]
    data = [player(i, "HOT", p, f"P{p}") for i in range(100) for p in range(11)]
    df = tables.player_stats_of(
        spark.createDataFrame(data, schemas.PLAYER_STATS),
        spark.createDataFrame(games, schemas.MATCHES))
    recent = pl.in_recent_games(df)
    assert recent.count() == 110
    assert recent.agg(F.min("id_jogo")).first()[0] == 90
    assert labels.DRAW == "Empate"
