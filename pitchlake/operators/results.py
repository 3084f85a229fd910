"""Tables made from match results: cards, league table, head-to-head, rankings.

Every operator groups by club (or pair, competition, odds band) over the whole
frame it is given; scope it first with ``pitchlake.sources.tables``. The season
is part of ``by`` or filtered by the caller, never implied.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions import fixed, labels
from pitchlake.functions.numeric import (
    count_if, exact, mean, pct, quotient, ratio, total,
)
from pitchlake.operators.club_games import (
    best, club_games, last_n, rank_all, top_per_group, worst,
)
from pitchlake.sources import tables

HAUL = 4  # goals scored that make a game a "goleada"


def _mean_of_sides(home: Column, away: Column) -> Column:
    """Mean of two means; the one that exists when the other side has no games."""
    return F.round(F.coalesce((home + away) / 2, home, away), 2).cast("double")


def _decimal_mean(c: Column) -> Column:
    return quotient(F.sum(exact(c)), F.count(c))


def season_card(games: DataFrame, by: Sequence[str] = ("clube",)) -> DataFrame:
    """Club card: results, goals, points share, over/under 2.5, odds and hauls."""
    home, away = F.col("mando") == "Casa", F.col("mando") == "Fora"
    won, haul = F.col("venceu") == 1, F.col("gols_marcados") >= HAUL
    odd = F.col("odd")
    n = F.col("jogos")
    sums = games.groupBy(*by).agg(
        F.count(F.lit(1)).alias("jogos"),
        total(F.col("venceu")).alias("vitorias"),
        total(F.col("empatou")).alias("empates"),
        total(F.col("perdeu")).alias("derrotas"),
        total(F.col("gols_marcados")).alias("gols_marcados"),
        total(F.col("gols_sofridos")).alias("gols_sofridos"),
        count_if(F.col("total_gols") >= 3).alias("over_2_5"),
        count_if(F.col("total_gols") < 3).alias("under_2_5"),
        _mean_of_sides(
            _decimal_mean(F.when(home, odd)), _decimal_mean(F.when(away, odd))
        ).alias("odd_media"),
        _mean_of_sides(
            _decimal_mean(F.when(home & won, odd)), _decimal_mean(F.when(away & won, odd))
        ).alias("odd_media_vitoria"),
        count_if(haul).alias("goleadas"),
        count_if(haul & home).alias("goleadas_mandante"),
        count_if(haul & away).alias("goleadas_visitante"),
    )
    return sums.select(
        *by, "jogos", "vitorias", "empates", "derrotas", "gols_marcados", "gols_sofridos",
        points_share().alias("aproveitamento"),
        "over_2_5", pct(F.col("over_2_5"), n).alias("prob_over_2_5"),
        "under_2_5", pct(F.col("under_2_5"), n).alias("prob_under_2_5"),
        "odd_media", "odd_media_vitoria",
        "goleadas", pct(F.col("goleadas"), n).alias("prob_golear"),
        "goleadas_mandante", "goleadas_visitante",
    )


def points_share() -> Column:
    """Share of the points that could be won, in %."""
    return pct(F.col("vitorias") * 3 + F.col("empates"), F.col("jogos") * 3)


def clean_games(games: DataFrame, by: Sequence[str] = ("clube",), rates: bool = False) -> DataFrame:
    """Games without conceding (clean sheets) and without scoring (clean goals)."""
    out = games.groupBy(*by).agg(
        F.count(F.lit(1)).alias("jogos"),
        count_if(F.col("gols_sofridos") == 0).alias("clean_sheets"),
        count_if(F.col("gols_marcados") == 0).alias("clean_goals"),
    )
    if not rates:
        return out.drop("jogos")
    return out.withColumns(
        {
            "tx_clean_sheets": ratio(F.col("clean_sheets"), F.col("jogos")),
            "tx_clean_goals": ratio(F.col("clean_goals"), F.col("jogos")),
        }
    )


def venue_strength(
    games: DataFrame, side: str, n: int | None = 10, by: Sequence[str] = ("clube",)
) -> DataFrame:
    """Strength at one venue over the last n games there."""
    played = games.filter(F.col("mando") == side)
    recent = played if n is None else last_n(played, n, by)
    won = F.col("venceu") == 1
    zero = F.lit(0.0)
    sums = recent.groupBy(*by).agg(
        F.count(F.lit(1)).alias("jogos"),
        total(F.col("venceu")).alias("vitorias"),
        total(F.col("empatou")).alias("empates"),
        total(F.col("perdeu")).alias("derrotas"),
        total(F.col("gols_marcados")).alias("gols_marcados"),
        total(F.col("gols_sofridos")).alias("gols_sofridos"),
        count_if(F.col("gols_sofridos") == 0).alias("clean_sheets"),
        count_if(F.col("gols_marcados") == 0).alias("clean_goals"),
        F.coalesce(mean(F.col("odd")), zero).alias("odd_media"),
        F.coalesce(mean(F.when(won, F.col("odd"))), zero).alias("odd_media_vitoria"),
    )
    return sums.withColumns(
        {
            "aproveitamento": points_share(),
            "media_marcados": ratio(F.col("gols_marcados"), F.col("jogos")),
            "media_sofridos": ratio(F.col("gols_sofridos"), F.col("jogos")),
        }
    )


def head_to_head(
    matches: DataFrame, a: str | None = None, b: str | None = None, n: int | None = None
) -> DataFrame:
    """Duel card of two clubs, or of every pair of clubs that met.

    Without ``a`` and ``b`` the pair is (name first in order, the other one). Odds
    are pooled over both venues; the winner's odds leave draws out.
    """
    met = matches.filter(labels.is_played())
    if a is not None and b is not None:
        pair = [a, b]
        met = met.filter(F.col("casa").isin(pair) & F.col("fora").isin(pair)).withColumns(
            {"clube_a": F.lit(a), "clube_b": F.lit(b)}
        )
    else:
        met = met.withColumns(
            {"clube_a": F.least("casa", "fora"), "clube_b": F.greatest("casa", "fora")}
        )
    by = ["clube_a", "clube_b"]
    if n is not None:
        met = last_n(met, n, by)
    ca, cb = F.col("clube_a"), F.col("clube_b")
    a_home = F.col("casa") == ca
    won = labels.winner()
    goals_a, goals_b = labels.goals_for(ca), labels.goals_for(cb)
    zero = F.lit(0.0)
    return met.groupBy(*by).agg(
        F.count(F.lit(1)).alias("jogos"),
        count_if(won == ca).alias("vitorias_a"),
        count_if(won == labels.DRAW).alias("empates"),
        count_if(won == cb).alias("vitorias_b"),
        total(goals_a).alias("gols_a"),
        total(goals_b).alias("gols_b"),
        mean(labels.total_goals()).alias("media_gols"),
        F.coalesce(
            mean(F.when(a_home, F.col("odd_casa")).otherwise(F.col("odd_fora"))), zero
        ).alias("odd_media_a"),
        F.coalesce(
            mean(F.when(a_home, F.col("odd_fora")).otherwise(F.col("odd_casa"))), zero
        ).alias("odd_media_b"),
        F.coalesce(mean(labels.winner_odds()), zero).alias("odd_media_vencedor"),
    )


def scorelines(
    matches: DataFrame,
    by: Sequence[str] = ("casa",),
    k: int | None = 10,
    last: int | None = None,
    denominator: str = "shown",
) -> DataFrame:
    """Most frequent scorelines of each group and their share.

    ``denominator='shown'`` divides by the rows listed, ``'all'`` by every game.
    ``by=('casa', 'fora')`` gives the duel seen from the home club.
    """
    if denominator not in ("shown", "all"):
        raise ValueError(f"unknown denominator: {denominator}")
    by = list(by)
    played = matches.filter(labels.is_played())
    if last is not None:
        played = last_n(played, last, by)
    counts = played.groupBy(*by, labels.scoreline().alias("placar")).agg(
        F.count(F.lit(1)).alias("qtd")
    )
    whole = F.sum("qtd").over(Window.partitionBy(*by))
    if denominator == "all":
        counts = counts.withColumn("_base", whole)
    if k is not None:
        counts = top_per_group(counts, k, by, [F.col("qtd").desc(), F.col("placar")])
    if denominator == "shown":
        counts = counts.withColumn("_base", whole)
    return counts.withColumn("prob", pct(F.col("qtd"), F.col("_base"))).drop("_base")


def duel_scorelines(
    matches: DataFrame, a: str, b: str, k: int | None = None, last: int | None = None
) -> DataFrame:
    """Scorelines of two clubs at either venue, always with the goals of ``a`` first."""
    at_a = F.col("casa") == a
    turned = tables.matches_between(matches, a, b).withColumns({
        "gols_casa": F.when(at_a, F.col("gols_casa")).otherwise(F.col("gols_fora")),
        "gols_fora": F.when(at_a, F.col("gols_fora")).otherwise(F.col("gols_casa")),
        "casa": F.lit(a), "fora": F.lit(b),
    })
    return scorelines(turned, ("casa", "fora"), k=k, last=last)


def club_country(games: DataFrame) -> DataFrame:
    """Country of each club: the most frequent one, any other before 'Mundo'; ties by name."""
    counts = games.filter(F.col("pais").isNotNull()).groupBy("clube", "pais").agg(
        F.count(F.lit(1)).alias("_n")
    )
    return _preferred_country(counts)


def _preferred_country(counts: DataFrame) -> DataFrame:
    order = [
        (F.lower("pais") == fixed.WORLD.lower()).asc(),
        F.col("_n").desc(),
        F.col("pais").asc(),
    ]
    return top_per_group(counts, 1, ["clube"], order).select("clube", "pais")


def league_table(matches: DataFrame) -> DataFrame:
    """Table of all clubs with country and rank.

    Counts are made once per (club, country); both the table and the club's
    country come from that small result.
    """
    games = club_games(matches)
    parts = games.groupBy("clube", "pais").agg(
        F.count(F.lit(1)).alias("_n"),
        total(F.col("venceu")).alias("v"),
        total(F.col("empatou")).alias("e"),
        total(F.col("perdeu")).alias("d"),
        total(F.col("gols_marcados")).alias("gm"),
        total(F.col("gols_sofridos")).alias("gs"),
    )
    table = parts.groupBy("clube").agg(
        F.sum("_n").alias("jogos"),
        F.sum("v").alias("vitorias"),
        F.sum("e").alias("empates"),
        F.sum("d").alias("derrotas"),
        F.sum("gm").alias("gols_marcados"),
        F.sum("gs").alias("gols_sofridos"),
        F.min(
            F.when(
                F.col("pais").isNotNull(),
                F.struct(
                    (F.lower("pais") == fixed.WORLD.lower()).alias("mundo"),
                    (-F.col("_n")).alias("n"),
                    F.col("pais"),
                ),
            )
        )["pais"].alias("pais"),
    )
    table = table.withColumns(
        {
            "saldo_gols": F.col("gols_marcados") - F.col("gols_sofridos"),
            "pontos": F.col("vitorias") * 3 + F.col("empates"),
            "aproveitamento": points_share(),
        }
    )
    ranked = rank_all(
        table,
        "aproveitamento",
        [
            F.col("vitorias").desc(), F.col("gols_marcados").desc(), F.col("saldo_gols").desc(),
            F.col("jogos").asc(), F.col("derrotas").asc(), F.col("gols_sofridos").asc(),
            F.col("clube").asc(),
        ],
    )
    return ranked.select(
        "posicao", "clube", "pais", "jogos", "vitorias", "empates", "derrotas",
        "gols_marcados", "gols_sofridos", "saldo_gols", "pontos", "aproveitamento",
    )


def competition_goals(matches: DataFrame) -> DataFrame:
    """Total goals, games and mean goals of each (competition, country)."""
    return (
        matches.filter(labels.is_played())
        .filter(F.col("campeonato").isNotNull() & F.col("pais").isNotNull())
        .groupBy("campeonato", "pais")
        .agg(
            total(labels.total_goals()).alias("total_gols"),
            F.count(F.lit(1)).alias("jogos"),
            mean(labels.total_goals()).alias("media_gols"),
        )
    )


def most_goals(goals: DataFrame, k: int = 10) -> DataFrame:
    return best(goals, "total_gols", k, ("campeonato", "pais"))


def highest_mean_goals(goals: DataFrame, min_games: int = 10, k: int = 10) -> DataFrame:
    return best(
        goals.filter(F.col("jogos") >= min_games), "media_gols", k, ("campeonato", "pais")
    )


def odds_bands(games: DataFrame) -> DataFrame:
    """Games, wins, non-wins and win rate of each odds band, in band order."""
    banded = games.withColumn("_b", labels.odds_band(F.col("odd"))).filter(
        F.col("_b").isNotNull()
    )
    return (
        banded.groupBy(F.col("_b.ordem").alias("ordem"), F.col("_b.faixa").alias("faixa_odd"))
        .agg(
            F.count(F.lit(1)).alias("total_jogos"),
            total(F.col("venceu")).alias("vitorias"),
            total(1 - F.col("venceu")).alias("derrotas"),
        )
        .withColumn("taxa_vitoria", pct(F.col("vitorias"), F.col("total_jogos")))
        .orderBy("ordem")
    )


def competition_card(
    matches: DataFrame, by: Sequence[str] = ("temporada", "campeonato", "pais")
) -> DataFrame:
    """Competition summary; the winners' odds are the mean of the two rounded side means."""
    won = labels.winner()
    home_won, away_won = won == F.col("casa"), won == F.col("fora")
    n = F.col("jogos")
    sums = (
        matches.filter(labels.is_played())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("jogos"),
            count_if(home_won).alias("vitorias_casa"),
            mean(F.col("odd_casa")).alias("odd_media_casa"),
            mean(F.when(home_won, F.col("odd_casa"))).alias("odd_media_vitoria_casa"),
            total(F.col("gols_casa")).alias("gols_casa"),
            count_if(won == labels.DRAW).alias("empates"),
            count_if(away_won).alias("vitorias_fora"),
            mean(F.col("odd_fora")).alias("odd_media_fora"),
            mean(F.when(away_won, F.col("odd_fora"))).alias("odd_media_vitoria_fora"),
            total(F.col("gols_fora")).alias("gols_fora"),
        )
    )
    h = F.col("odd_media_vitoria_casa").cast("decimal(18,2)")
    a = F.col("odd_media_vitoria_fora").cast("decimal(18,2)")
    return sums.withColumns(
        {
            "prob_vitorias_casa": pct(F.col("vitorias_casa"), n),
            "media_gols_casa": ratio(F.col("gols_casa"), n),
            "prob_vitorias_fora": pct(F.col("vitorias_fora"), n),
            "media_gols_fora": ratio(F.col("gols_fora"), n),
            "gols": F.col("gols_casa") + F.col("gols_fora"),
            "media_gols": ratio(F.col("gols_casa") + F.col("gols_fora"), n),
            "odd_media_vencedor": _mean_of_sides(h, a),
        }
    )


def club_counts(games: DataFrame, by: Sequence[str] = ("clube",)) -> DataFrame:
    """Wins and losses of each club; clubs without any are kept with 0."""
    return games.groupBy(*by).agg(
        total(F.col("venceu")).alias("vitorias"), total(F.col("perdeu")).alias("derrotas")
    )


def points_per_game(
    games: DataFrame, side: str | None = None, by: Sequence[str] = ("clube",)
) -> DataFrame:
    """Mean points per game, at one venue or overall."""
    scoped = games if side is None else games.filter(F.col("mando") == side)
    return scoped.groupBy(*by).agg(mean(F.col("pontos")).alias("pontuacao"))


def goals_table(
    games: DataFrame, column: str = "gols_marcados", by: Sequence[str] = ("clube",)
) -> DataFrame:
    """Total and mean of goals scored (or conceded) by each club."""
    return games.groupBy(*by).agg(
        total(F.col(column)).alias("total"), mean(F.col(column)).alias("media")
    )


def extremes(
    table: DataFrame, metric: str, k: int = 5, tie: Sequence[str] = ("clube",)
) -> DataFrame:
    """Best k and worst k rows of a report table, told apart by ``lista``."""
    cols = [*tie, F.col(metric).alias("valor")]
    high = best(table, metric, k, tie).select(F.lit("maior").alias("lista"), *cols)
    low = worst(table, metric, k, tie).select(F.lit("menor").alias("lista"), *cols)
    return high.unionByName(low)
