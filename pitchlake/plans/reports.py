"""The four report sets, each a dictionary of report name -> DataFrame.

Only the small shared tables (rows of the recent games) are written when a report
set is built, once for all the lists that use them; every report is an ordinary
lazy DataFrame. Write a set with
``operators.sinks.save_reports``.
"""

import datetime

from pyspark.sql import DataFrame

from pitchlake.functions import fixed
from pitchlake.operators import players as pl
from pitchlake.operators import reports, results, streaks
from pitchlake.operators import team_stats as ts
from pitchlake.operators.club_games import best, club_games, last_n
from pitchlake.session import materialise
from pitchlake.sources import tables

Reports = dict[str, DataFrame]


def _of(df: DataFrame, clubs: list[str], column: str = "clube") -> DataFrame:
    return df.filter(df[column].isin(clubs))


def _player_lists(rows: DataFrame, prefix: str, per: tuple[str, ...] = ()) -> Reports:
    """The ten leaderboards over rows already cut to the recent games."""

    def top(metric: str, how: str = "sum", k: int = 10, per=per, **rule) -> DataFrame:
        table = pl.totals(rows, metric, how, with_minutes="min_minutes" in rule)
        return pl.leaders(table, k, per, **rule)

    return {
        f"{prefix}_minutos": top("minutes_played", k=5, per=("team",)),
        f"{prefix}_gols": top("goals", above=0),
        f"{prefix}_assistencias": top("goal_assist", above=0),
        f"{prefix}_participacao": top("participacao", above=0),
        f"{prefix}_rating_total": top("rating", k=5, per=("team",), above=0),
        f"{prefix}_rating_medio": top("rating", "mean", min_minutes=90),
        f"{prefix}_grandes_chances": top("big_chance_created", above=0),
        f"{prefix}_passes_chave": top("key_pass", above=0),
        f"{prefix}_xg_total": top("expected_goals", above=0),
        f"{prefix}_xg_medio": top("expected_goals", "mean", above=0),
    }


def duel_report(
    matches: DataFrame,
    team_stats: DataFrame,
    player_stats: DataFrame,
    casa: str,
    fora: str,
    temporada: str,
    n: int = 10,
) -> Reports:
    """Everything about an upcoming match of two clubs."""
    pair = [casa, fora]
    own = tables.matches_of(matches, pair)
    season = tables.matches_in(own, temporada)
    games, all_games = _of(club_games(season), pair), _of(club_games(own), pair)
    recent = last_n(games, n)

    def card(frame: DataFrame) -> DataFrame:
        lines = reports.card_rows(results.season_card(frame), fixed.SEASON_CARD)
        return reports.side_by_side(lines, pair)

    def strength(club: str, side: str) -> DataFrame:
        table = results.venue_strength(_of(all_games, [club]), side, n)
        return reports.card_rows(table, fixed.STRENGTH_CARD)

    stats = tables.team_stats_of(team_stats, season, clubs=pair)
    periods = reports.card_rows(
        ts.period_card(stats, n), fixed.TEAM_CARD, ("periodo", "temporada", "clube")
    )
    season_players = tables.player_stats_of(player_stats, season, pair)
    recent_players = materialise(pl.in_recent_games(season_players, n), "recent-players")
    lineup = pl.probable_lineup(tables.player_stats_of(player_stats, own, pair), n)
    at_home = own.filter(own["casa"] == casa)
    away = own.filter(own["fora"] == fora)
    return {
        "desempenho_temporada": card(games),
        "desempenho_recente": card(recent),
        "clean_sheets_recente": results.clean_games(recent),
        "forca_mandante": strength(casa, "Casa"),
        "forca_visitante": strength(fora, "Fora"),
        "confronto_direto": results.head_to_head(matches, casa, fora),
        "confronto_direto_recente": results.head_to_head(matches, casa, fora, n),
        "primeiro_tempo": periods.filter("periodo = '1ST'"),
        "segundo_tempo": periods.filter("periodo = '2ND'"),
        "jogo_completo": periods.filter("periodo = 'ALL'"),
        "placares_mandante": results.scorelines(at_home, ("casa",)),
        "placares_mandante_recente": results.scorelines(at_home, ("casa",), last=n),
        "placares_visitante": results.scorelines(away, ("fora",)),
        "placares_visitante_recente": results.scorelines(away, ("fora",), last=n),
        "placares_confronto": results.scorelines(
            at_home.filter(at_home["fora"] == fora), ("casa", "fora"), k=None
        ),
        "placares_confronto_geral": results.duel_scorelines(own, casa, fora),
        "escalacao_provavel": lineup,
        "formacao": pl.formation(lineup),
        **_player_lists(recent_players, "jogadores"),
    }


def club_report(
    matches: DataFrame,
    team_stats: DataFrame,
    player_stats: DataFrame,
    clube: str,
    temporada: str,
    n: int = 10,
) -> Reports:
    """The same for a single club, with its home and away strength."""
    own = tables.matches_of(matches, [clube])
    season = tables.matches_in(own, temporada)
    games = _of(club_games(season), [clube])
    all_games = _of(club_games(own), [clube])
    recent = last_n(games, n)
    stats = tables.team_stats_of(team_stats, season, clubs=[clube])
    rows = materialise(
        pl.in_recent_games(tables.player_stats_of(player_stats, season, [clube]), n),
        "recent-players",
    )
    return {
        "desempenho_temporada": results.season_card(games),
        "desempenho_recente": results.season_card(recent),
        "clean_sheets_recente": results.clean_games(recent),
        "como_mandante": results.venue_strength(all_games, "Casa", n),
        "como_visitante": results.venue_strength(all_games, "Fora", n),
        "estatisticas": ts.period_card(stats, n),
        **_player_lists(rows, "jogadores"),
    }


def profile_report(
    matches: DataFrame,
    team_stats: DataFrame,
    player_stats: DataFrame,
    casa: str,
    fora: str,
    temporada: str,
    as_of: datetime.date | str,
    n: int = 10,
) -> Reports:
    """Two clubs compared: chances, attack, possession, defence, duels, pressing, squad."""
    pair = [casa, fora]
    season = tables.matches_in(tables.matches_of(matches, pair), temporada)
    rows = materialise(
        _of(ts.faced(team_stats, season, n), pair, "clube_analise"), "recent-stats"
    )
    players = materialise(
        pl.in_recent_games(
            tables.player_stats_of(player_stats, season, pair), n, ("temporada", "team")
        ),
        "recent-players",
    )

    def top(metric: str, how: str, k: int = 10) -> DataFrame:
        return pl.leaders(pl.totals(players, metric, how), k, ("team",))

    return {
        "chances": ts.chances_profile(rows),
        "ataque": ts.attack_profile(rows),
        "posse": ts.possession_profile(rows),
        "defesa": ts.defence_profile(rows),
        "duelos": ts.duel_profile(rows),
        "pressao": ts.pressing_index(rows),
        "amarelos": ts.yellow_cards(rows),
        "disciplina": ts.player_discipline(players),
        "jogadores_minutos": top("minutes_played", "sum", 11),
        "jogadores_rating_total": top("rating", "sum"),
        "jogadores_rating_medio": top("rating", "mean"),
        "jogadores_toques": top("touches", "mean"),
        "jogadores_passes": top("total_pass", "mean"),
        "jogadores_passes_certos": top("accurate_pass", "mean"),
        "idade_e_valor": pl.squad_age_and_value(players, as_of),
    }


def monthly_report(
    matches: DataFrame,
    team_stats: DataFrame,
    player_stats: DataFrame,
    as_of: datetime.date | str,
) -> Reports:
    """Tables of the calendar month before ``as_of``, over all competitions."""
    month = tables.matches_prev_month(matches, as_of)
    table = results.league_table(month)
    goals = results.competition_goals(month)
    stats = materialise(
        tables.without_friendlies(tables.team_stats_of(team_stats, month)), "month-stats")
    players = materialise(tables.player_stats_of(player_stats, month), "month-players")
    out = {
        "classificacao": table,
        "melhores_ataques": best(table, "gols_marcados", 10),
        "mais_gols_sofridos": best(table, "gols_sofridos", 10),
        "gols_por_campeonato": results.most_goals(goals),
        "maior_media_de_gols": results.highest_mean_goals(goals),
        "faixas_de_odds": results.odds_bands(club_games(month)),
        "posse_de_bola": ts.leaderboard(stats, ["ball_possession"], "mean", min_games=3),
        "duelos_ganhos": ts.leaderboard(stats, ["duels"], "mean", min_games=3, truncate=True),
        "xg": ts.leaderboard(stats, ["expected_goals"], "mean"),
        "totais": ts.leaderboard(stats, fixed.MONTHLY_SUM_METRICS),
        "cartoes_vermelhos": ts.red_card_leaders(stats),
    }
    for name, metric, above in (
        ("minutos", "minutes_played", None), ("gols", "goals", 0), ("assistencias", "goal_assist", 0)
    ):
        totals = pl.with_teams(players, metric)
        out[f"jogadores_{name}"] = pl.leaders(totals, above=above)
        out[f"jogadores_{name}_por_posicao"] = pl.leaders(totals, per=("position",), above=above)
    return out


def competition_report(
    matches: DataFrame,
    team_stats: DataFrame,
    player_stats: DataFrame,
    temporada: str,
    campeonato: str,
    pais: str,
) -> Reports:
    """Tables of one competition in one season."""
    scope = tables.matches_in(matches, temporada, campeonato, pais)
    games = club_games(scope)
    stats = materialise(tables.team_stats_of(team_stats, scope, "ALL"), "scope-stats")
    players = materialise(tables.player_stats_of(player_stats, scope), "scope-players")
    unbeaten = materialise(streaks.runs(games, streaks.UNBEATEN), "runs")
    winning = materialise(streaks.runs(games, streaks.WINNING), "runs")
    wins = results.club_counts(games)
    clean = results.clean_games(games)
    made = results.goals_table(games)
    conceded = results.goals_table(games, "gols_sofridos")

    def top(metric: str, above: float, how: str = "sum") -> DataFrame:
        return pl.leaders(pl.totals(players, metric, how), above=above)

    return {
        "desempenho": reports.card_rows(
            results.competition_card(scope), fixed.COMPETITION_CARD,
            ("temporada", "campeonato", "pais"),
        ),
        "vitorias": results.extremes(wins, "vitorias"),
        "derrotas": results.extremes(wins, "derrotas"),
        "ppj_casa": results.extremes(results.points_per_game(games, "Casa"), "pontuacao"),
        "ppj_fora": results.extremes(results.points_per_game(games, "Fora"), "pontuacao"),
        "ppj_geral": results.extremes(results.points_per_game(games), "pontuacao"),
        "gols_marcados": results.extremes(made, "total"),
        "gols_marcados_media": results.extremes(made, "media"),
        "gols_sofridos": results.extremes(conceded, "total"),
        "gols_sofridos_media": results.extremes(conceded, "media"),
        "clean_sheets": results.extremes(clean, "clean_sheets"),
        "clean_goals": results.extremes(clean, "clean_goals"),
        "invencibilidade": results.extremes(unbeaten, "maior"),
        "invencibilidade_atual": results.extremes(unbeaten, "atual"),
        "vitorias_seguidas": results.extremes(winning, "maior"),
        "vitorias_seguidas_atual": results.extremes(winning, "atual"),
        "medias": ts.leaderboard(
            stats, ["ball_possession", "expected_goals", "big_chances", "goalkeeper_saves"],
            "mean", by=(),
        ),
        "medias_inteiras": ts.leaderboard(
            stats, ["total_shots", "shots_on_target", "shots_inside_box", "final_third_entries"],
            "mean", by=(), truncate=True,
        ),
        "menor_xg": ts.leaderboard(stats, ["expected_goals"], "mean", by=(), largest=False),
        "aproveitamentos": ts.ratio_leaderboard(stats),
        "jogadores_minutos": pl.leaders(pl.totals(players, "minutes_played"), per=("position",)),
        "jogadores_gols": top("goals", 0),
        "jogadores_assistencias": top("goal_assist", 0),
        "jogadores_participacao": top("participacao", 0),
        "jogadores_grandes_chances": top("big_chance_created", 0),
        "jogadores_passes_chave": top("key_pass", 0),
        "jogadores_rating_total": top("rating", 0),
        "jogadores_xg_total": top("expected_goals", 1),
        "jogadores_rating_medio": pl.leaders(pl.regulars(players, "rating"), above=0),
        "jogadores_xg_medio": pl.leaders(pl.regulars(players, "expected_goals"), above=0),
    }
