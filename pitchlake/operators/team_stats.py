"""Team statistics: period cards, leaderboards and own-versus-opponent profiles."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions import text
from pitchlake.functions.numeric import (
    decimal_total, exact, mean, pct, ratio, total, truncated,
)
from pitchlake.operators.club_games import (
    CHRONOLOGICAL, club_games, last_n, last_n_of_wide, top_per_group,
)
from pitchlake.session import materialise

CARD_KEY = ("periodo", "temporada", "clube")
PERCENT_COLUMNS = ("ball_possession", "duels", "tackles_won")


def typed(stats: DataFrame) -> DataFrame:
    """Percentage texts that are present become numbers (bad text becomes NULL)."""
    present = [c for c in PERCENT_COLUMNS if c in stats.columns]
    return stats.withColumns({c: text.percent(F.col(c)) for c in present})


# --- period card ---------------------------------------------------------------
def period_card(stats: DataFrame, n: int | None = 10, by: Sequence[str] = CARD_KEY) -> DataFrame:
    """The 30-line card of each club for each period, over its last n games.

    Halves and full match are one aggregation, because the period is a key. Red
    cards are recorded by half, so the full match takes the sum of both halves.
    """
    recent = typed(stats if n is None else last_n_of_wide(stats, n, by))
    c = F.col
    jogos = c("jogos")
    sums = recent.groupBy(*by).agg(
        F.count(F.lit(1)).alias("jogos"),
        mean(c("ball_possession")).alias("posse_bola"),
        mean(c("expected_goals")).alias("xg_medio"),
        decimal_total(c("expected_goals")).alias("xg_total"),
        total(c("big_chances")).alias("grandes_chances"),
        total(c("big_chances_scored")).alias("grandes_chances_convertidas"),
        total(c("total_shots")).alias("finalizacoes"),
        total(c("shots_on_target")).alias("finalizacoes_certas"),
        total(c("shots_inside_box")).alias("finalizacoes_area"),
        total(c("hit_woodwork")).alias("bolas_trave"),
        total(c("corner_kicks")).alias("escanteios"),
        total(c("passes")).alias("passes"),
        total(c("accurate_passes")).alias("passes_certos"),
        total(c("final_third_entries")).alias("entradas_terco_final"),
        total(c("fouled_in_final_third")).alias("faltas_terco_final"),
        total(c("dispossessed")).alias("perdas_bola"),
        mean(c("duels")).alias("duelos_ganhos"),
        total(c("yellow_cards")).alias("amarelos"),
        total(c("red_cards")).alias("_vermelhos"),
    )
    others = [k for k in by if k != "periodo"]
    halves = F.sum(F.when(c("periodo") != "ALL", c("_vermelhos"))).over(
        Window.partitionBy(*others)
    )
    return sums.withColumns(
        {
            "vermelhos": F.when(c("periodo") == "ALL", F.coalesce(halves, F.lit(0))).otherwise(
                c("_vermelhos")
            ),
            "grandes_chances_jogo": ratio(c("grandes_chances"), jogos),
            "aproveitamento_grandes_chances": pct(
                c("grandes_chances_convertidas"), c("grandes_chances")
            ),
            "finalizacoes_jogo": ratio(c("finalizacoes"), jogos),
            "finalizacoes_certas_jogo": ratio(c("finalizacoes_certas"), jogos),
            "acerto_finalizacoes": pct(c("finalizacoes_certas"), c("finalizacoes")),
            "finalizacoes_area_jogo": ratio(c("finalizacoes_area"), jogos),
            "perc_finalizacoes_area": pct(c("finalizacoes_area"), c("finalizacoes")),
            "escanteios_jogo": ratio(c("escanteios"), jogos),
            "assertividade_passes": pct(c("passes_certos"), c("passes")),
            "entradas_terco_final_jogo": ratio(c("entradas_terco_final"), jogos),
            "perdas_bola_jogo": ratio(c("perdas_bola"), jogos),
        }
    ).drop("_vermelhos")


# --- leaderboards ----------------------------------------------------------------
def leaderboard(
    stats: DataFrame,
    metrics: Sequence[str],
    how: str = "sum",
    k: int = 10,
    by: Sequence[str] = ("periodo",),
    min_games: int | None = None,
    min_value: int | None = None,
    digits: int = 2,
    truncate: bool = False,
    largest: bool = True,
) -> DataFrame:
    """Top (or bottom) k clubs of each metric, in one pass over the rows.

    ``how`` is 'sum' or 'mean'. The sums of all metrics are made together, then
    turned into (metrica, valor) rows and ranked inside (by, metrica).
    """
    aggs = [_measure(m, how, digits, truncate).alias(m) for m in metrics]
    wide = typed(stats).groupBy(*by, "clube").agg(*aggs, F.count(F.lit(1)).alias("_games"))
    if min_games is not None:
        wide = wide.filter(F.col("_games") >= min_games)
    long = wide.select(
        *by, "clube",
        F.explode(
            F.array(*[
                F.struct(F.lit(m).alias("metrica"), F.col(m).cast("double").alias("valor"))
                for m in metrics
            ])
        ).alias("_m"),
    ).select(*by, "clube", "_m.*").filter(F.col("valor").isNotNull())
    if min_value is not None:
        long = long.filter(F.col("valor") > min_value)
    order = F.col("valor").desc() if largest else F.col("valor").asc()
    return top_per_group(long, k, [*by, "metrica"], [order, F.col("clube")], "posicao")


def _measure(metric: str, how: str, digits: int, truncate: bool) -> Column:
    c = F.col(metric)
    if how == "sum":
        return total(c)
    if how == "mean":
        if truncate:
            return truncated(F.sum(exact(c)), F.count(c))
        return mean(c, digits)
    raise ValueError(f"unknown measure: {how}")


def red_card_leaders(
    stats: DataFrame, k: int = 10, more_than: int = 1, by: Sequence[str] = ()
) -> DataFrame:
    """Clubs with more than one red card: each half, and both halves added as 'ALL'.

    Clubs with cards in one half only are part of the full-match list.
    """
    halves = (
        stats.filter(F.col("periodo") != "ALL")
        .groupBy(*by, "clube", "periodo")
        .agg(total(F.col("red_cards")).alias("vermelhos"))
    )
    whole = halves.groupBy(*by, "clube").agg(F.sum("vermelhos").alias("vermelhos"))
    rows = halves.unionByName(whole.withColumn("periodo", F.lit("ALL")))
    return top_per_group(
        rows.filter(F.col("vermelhos") > more_than),
        k, [*by, "periodo"], [F.col("vermelhos").desc(), F.col("clube")], "posicao",
    )


RATIOS = {
    "finalizacoes": ("shots_on_target", "total_shots"),
    "grandes_chances": ("big_chances_scored", "big_chances"),
    "passes": ("accurate_passes", "passes"),
}


def ratio_leaderboard(stats: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean of each game's own percentage (rounded first); games with 0/0 are skipped."""
    shares = {
        name: ratio(F.col(part), F.col(whole), factor=100)
        for name, (part, whole) in RATIOS.items()
    }
    rows = stats.select(*by, "clube", *[share.alias(name) for name, share in shares.items()])
    return leaderboard(rows, list(RATIOS), "mean", k, by)


# --- own rows against the opponent's rows ----------------------------------------
def faced(
    team_stats: DataFrame,
    matches: DataFrame,
    n: int | None = 10,
    by: Sequence[str] = ("temporada", "clube"),
    periodo: str = "ALL",
) -> DataFrame:
    """Statistics of both sides of each club's last n games, seen from that club.

    The recent games (at most n per club) are written once to the shared folder;
    Spark then knows their size, and a small list is broadcast instead of shuffling
    the statistics. ``proprio`` tells the club's own row from the opponent's. A
    match of two recent opponents gives rows for each of them.
    """
    games = club_games(matches)
    recent = games.select(
        *dict.fromkeys([*by, "temporada"]), F.col("clube").alias("clube_analise"), *CHRONOLOGICAL,
        "gols_marcados", "gols_sofridos"
    )
    if n is not None:
        recent = materialise(last_n(recent, n, by), "recent-games")
    recent = recent.drop("clube", *(c for c in CHRONOLOGICAL if c != "id_jogo"))
    stats = typed(team_stats.filter(F.col("periodo") == periodo).drop("periodo"))
    rows = stats.join(recent, ["id_jogo", "temporada"]).withColumn(
        "proprio", F.col("clube") == F.col("clube_analise")
    )
    return rows if "temporada" in by else rows.drop("temporada")


def _own(c) -> Column:
    return F.when(F.col("proprio"), c if isinstance(c, Column) else F.col(c))


def _other(c) -> Column:
    return F.when(~F.col("proprio"), c if isinstance(c, Column) else F.col(c))


def _own_games() -> Column:
    return F.count_if(F.col("proprio"))


PROFILE_KEY = ("temporada", "clube_analise")


def chances_profile(rows: DataFrame, by: Sequence[str] = PROFILE_KEY) -> DataFrame:
    """xG, big chances, conversion and goals, for and against."""
    c = F.col
    xg, big, scored = "expected_goals", "big_chances", "big_chances_scored"
    sums = rows.groupBy(*by).agg(
        _own_games().alias("jogos"),
        mean(_own(xg)).alias("xg_favor"),
        mean(_other(xg)).alias("xg_contra"),
        mean(_own(big)).alias("grandes_chances_favor"),
        mean(_other(big)).alias("grandes_chances_contra"),
        ratio(F.sum(_own(scored)), F.sum(_own(big)), factor=100).alias("conversao_favor"),
        ratio(F.sum(_other(scored)), F.sum(_other(big)), factor=100).alias("conversao_contra"),
        mean(_own("big_chances_missed")).alias("chances_perdidas_favor"),
        mean(_other("big_chances_missed")).alias("chances_perdidas_contra"),
        mean(_own("gols_marcados")).alias("gols_marcados_jogo"),
        mean(_own("gols_sofridos")).alias("gols_sofridos_jogo"),
    )

    def minus(a: str, b: str) -> Column:
        return (c(a).cast("decimal(18,2)") - c(b).cast("decimal(18,2)")).cast("double")

    return sums.withColumns(
        {
            "saldo_xg": minus("xg_favor", "xg_contra"),
            "gols_menos_xg_favor": minus("gols_marcados_jogo", "xg_favor"),
            "gols_menos_xg_contra": minus("gols_sofridos_jogo", "xg_contra"),
        }
    )


def attack_profile(rows: DataFrame, by: Sequence[str] = PROFILE_KEY) -> DataFrame:
    """Shots, box share, xG per shot, woodwork, entries, corners, crosses, long balls."""
    crosses, long_balls = text.won_of_total(F.col("crosses")), text.won_of_total(F.col("long_balls"))
    rows = rows.withColumns({"_crosses": crosses, "_long": long_balls})
    shots = F.sum(_own("total_shots"))
    xg = exact(F.col("expected_goals"))
    # Only games with an xG value count in the denominator of xG per shot.
    with_xg = F.when(F.col("expected_goals").isNotNull(), F.col("total_shots"))
    set_pieces = F.coalesce("corner_kicks", F.lit(0)) + F.coalesce("fouled_in_final_third", F.lit(0))
    return rows.groupBy(*by).agg(
        _own_games().alias("jogos"),
        mean(_own("total_shots")).alias("chutes_jogo"),
        mean(_own("shots_on_target")).alias("chutes_alvo_jogo"),
        mean(_own("shots_off_target")).alias("chutes_fora_jogo"),
        mean(_own("blocked_shots")).alias("chutes_bloqueados_jogo"),
        ratio(F.sum(_own("shots_inside_box")), shots, factor=100).alias("perc_dentro_area"),
        ratio(F.sum(_own("shots_outside_box")), shots, factor=100).alias("perc_fora_area"),
        ratio(F.sum(_own(xg)), F.sum(_own(with_xg))).alias("xg_por_chute_favor"),
        ratio(F.sum(_other(xg)), F.sum(_other(with_xg))).alias("xg_por_chute_contra"),
        total(_own("hit_woodwork")).alias("trave_favor"),
        total(_other("hit_woodwork")).alias("trave_contra"),
        mean(_own("through_balls")).alias("passes_profundidade_jogo"),
        mean(_own("final_third_entries")).alias("entradas_favor"),
        mean(_other("final_third_entries")).alias("entradas_contra"),
        mean(_own("fouled_in_final_third")).alias("faltas_terco_final"),
        mean(_own("corner_kicks")).alias("escanteios_favor"),
        mean(_other("corner_kicks")).alias("escanteios_contra"),
        mean(_own(F.col("_crosses.acerto"))).alias("acuracia_cruzamentos"),
        ratio(
            F.sum(_own(F.col("_crosses.total"))), F.sum(_own("final_third_entries")), factor=100
        ).alias("cruzamentos_por_entrada"),
        ratio(
            F.sum(_own(F.col("_long.total"))), F.sum(_own("passes")), factor=100
        ).alias("perc_bolas_longas"),
        mean(_own(set_pieces)).alias("bola_parada_jogo"),
    )


def possession_profile(rows: DataFrame, by: Sequence[str] = PROFILE_KEY) -> DataFrame:
    """Possession, passing volume and accuracy, long balls, through balls per 100 passes."""
    rows = rows.withColumn("_long", text.won_of_total(F.col("long_balls")))
    passes = F.sum(_own("passes"))
    return rows.groupBy(*by).agg(
        _own_games().alias("jogos"),
        mean(_own("ball_possession")).alias("posse_bola"),
        mean(_own("passes")).alias("passes_jogo"),
        ratio(F.sum(_own("accurate_passes")), passes, factor=100).alias("acerto_passes"),
        ratio(F.sum(_own(F.col("_long.total"))), passes, factor=100).alias("perc_bolas_longas"),
        ratio(F.sum(_own("through_balls")), passes, factor=100).alias("profundidade_por_100"),
    )


def defence_profile(rows: DataFrame, by: Sequence[str] = PROFILE_KEY) -> DataFrame:
    """Shots allowed, blocks, tackles, interceptions, recoveries, clearances."""
    return rows.groupBy(*by).agg(
        _own_games().alias("jogos"),
        mean(_other("total_shots")).alias("chutes_sofridos_jogo"),
        mean(_own("blocked_shots")).alias("bloqueios_jogo"),
        mean(_own("tackles")).alias("desarmes_jogo"),
        mean(_own("tackles_won")).alias("perc_desarmes_ganhos"),
        mean(_own("interceptions")).alias("interceptacoes_jogo"),
        mean(_own("recoveries")).alias("recuperacoes_jogo"),
        mean(_own("clearances")).alias("cortes_jogo"),
        mean(_own("dispossessed")).alias("perdas_jogo"),
    )


def duel_profile(rows: DataFrame, by: Sequence[str] = PROFILE_KEY) -> DataFrame:
    """Share of duels won: overall, on the ground and in the air (mean of the games)."""
    rows = rows.withColumns(
        {
            "_ground": text.won_of_total(F.col("ground_duels"))["acerto"],
            "_aerial": text.won_of_total(F.col("aerial_duels"))["acerto"],
        }
    )
    return rows.groupBy(*by).agg(
        _own_games().alias("jogos"),
        mean(_own("duels")).alias("duelos_ganhos"),
        mean(_own("_ground")).alias("duelos_chao"),
        mean(_own("_aerial")).alias("duelos_aereos"),
    )


def pressing_index(rows: DataFrame, by: Sequence[str] = PROFILE_KEY) -> DataFrame:
    """Opponent passes per own defensive action."""
    actions = sum(
        (F.coalesce(c, F.lit(0)) for c in ("interceptions", "recoveries", "clearances")),
        F.coalesce("tackles", F.lit(0)),
    )
    return rows.groupBy(*by).agg(
        _own_games().alias("jogos"),
        ratio(F.sum(_other("passes")), F.sum(_own(actions))).alias("indice_pressao"),
    )


def yellow_cards(rows: DataFrame, by: Sequence[str] = PROFILE_KEY) -> DataFrame:
    return rows.groupBy(*by).agg(total(_own("yellow_cards")).alias("amarelos"))


PLAYER_FAULTS = {
    "fouls": "faltas_jogo",
    "penalty_conceded": "penaltis_cometidos_jogo",
    "error_lead_to_a_shot": "erros_finalizacao_jogo",
    "error_lead_to_a_goal": "erros_gol_jogo",
}


def player_discipline(
    players: DataFrame, by: Sequence[str] = ("temporada", "team")
) -> DataFrame:
    """Fouls, penalties conceded and errors per game from (recent) player rows."""
    per_game = players.groupBy(*by, "id_jogo").agg(
        *[total(F.col(c)).alias(c) for c in PLAYER_FAULTS]
    )
    return per_game.groupBy(*by).agg(
        F.count(F.lit(1)).alias("jogos"),
        *[ratio(F.sum(c), F.count(F.lit(1))).alias(name) for c, name in PLAYER_FAULTS.items()],
    )
