"""Scopes over the stored tables: by club, competition, month, pair, period.

Each one is a filter or an equi join on the match id, so predicates and column
lists reach the Parquet scan.

The match decides the season of its statistics: they join on the match id alone, so a row
whose own season is missing or spelt in another way ('2025', '2025/2026') is still found.
``seasons`` is a hint that prunes season folders; it keeps rows without a season, and
``join_audit`` counts what it would miss. ``accounted`` gives every row with what became of it.
"""

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import fixed, labels
from pitchlake.operators import sinks
from pitchlake.session import configure

ID, SEASON = "id_jogo", "temporada"
MATCH_CONTEXT = ("data", "hora", "campeonato", "pais", "casa", "fora")

#: What becomes of a statistics row in the join with its match.
MATCHED, SEASON_DIFFERS, NO_SEASON, NO_MATCH, NO_ID = (
    "ok", "temporada difere", "sem temporada", "sem jogo", "sem id")


def matches_of(matches: DataFrame, clubs: Sequence[str]) -> DataFrame:
    """Matches in which any of the clubs played."""
    return matches.filter(F.col("casa").isin(list(clubs)) | F.col("fora").isin(list(clubs)))


def matches_in(
    matches: DataFrame,
    temporada: str | None = None,
    campeonato: str | None = None,
    pais: str | None = None,
) -> DataFrame:
    """Matches of a season, competition and country; each part is optional."""
    for column, value in (("temporada", temporada), ("campeonato", campeonato), ("pais", pais)):
        if value is not None:
            matches = matches.filter(F.col(column) == value)
    return matches


def previous_month(as_of: datetime.date | str) -> Column:
    """Predicate on ``data``: the calendar month before the one of ``as_of``."""
    month = F.trunc(F.lit(str(as_of)).cast("date"), "month")
    return (F.col("data") >= F.add_months(month, -1)) & (F.col("data") < month)


def matches_prev_month(matches: DataFrame, as_of: datetime.date | str) -> DataFrame:
    return matches.filter(previous_month(as_of))


def matches_between(matches: DataFrame, a: str, b: str) -> DataFrame:
    """Matches of two clubs against each other, at either venue."""
    pair = [a, b]
    return matches.filter(F.col("casa").isin(pair) & F.col("fora").isin(pair))


def without_friendlies(df: DataFrame) -> DataFrame:
    """Drop qualifiers and friendlies from monthly team tables."""
    return df.filter(~F.col("campeonato").isin(fixed.EXCLUDED_COMPETITIONS))


def _context(matches: DataFrame) -> DataFrame:
    return matches.select(ID, SEASON, *MATCH_CONTEXT)


def in_seasons(rows: DataFrame, seasons: Sequence[str] | None) -> DataFrame:
    """Rows stored under one of the season spellings, and those without a season."""
    if seasons is None:
        return rows
    return rows.filter(F.col(SEASON).isin(list(seasons)) | F.col(SEASON).isNull())


def _with_match(rows: DataFrame, matches: DataFrame, seasons: Sequence[str] | None) -> DataFrame:
    """Rows with the context of their match, whose season they take."""
    configure(rows.sparkSession)  # wide rows are not sorted for the join
    return in_seasons(rows, seasons).drop(SEASON).join(_context(matches), ID)


def accounted(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Every row once, with the context of its match where there is one.

    ``situacao`` says what became of it: matched, matched under another season or without one,
    no such match, no match id. ``temporada`` stays the row's own, the match's is
    ``temporada_jogo``. A match that comes more than once counts as its fullest copy. Rows
    without an id do not enter the join, so they are no hot key.
    """
    named = [c for c in MATCH_CONTEXT if c not in rows.columns]
    context = sinks.one_per_key(
        matches.filter(F.col(ID).isNotNull()).select(ID, F.col(SEASON).alias("temporada_jogo"), *named), [ID])
    found = rows.filter(F.col(ID).isNotNull()).join(context.withColumn("_jogo", F.lit(True)), ID, "left")
    own, of_match = F.col(SEASON), F.col("temporada_jogo")
    state = (
        F.when(F.col("_jogo").isNull(), NO_MATCH)
        .when(own.eqNullSafe(of_match), MATCHED)
        .when(own.isNull(), NO_SEASON)
        .otherwise(SEASON_DIFFERS)
    )
    lost = rows.filter(F.col(ID).isNull()).withColumn("situacao", F.lit(NO_ID))
    return found.withColumn("situacao", state).drop("_jogo").unionByName(lost, allowMissingColumns=True)


def join_audit(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """(situacao, temporada, temporada_jogo, linhas, jogos): what the join keeps and loses.

    A pruned join (``seasons``) is whole where this has no row of another season than the
    match's, a join on the id alone where it has no row without a match or an id.
    """
    return accounted(rows.select(ID, SEASON), matches).groupBy("situacao", SEASON, "temporada_jogo").agg(
        F.count(F.lit(1)).alias("linhas"), F.countDistinct(ID).alias("jogos"))


def with_match_season(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows under the season of their match, as they should be stored; unknown matches keep theirs.

    After this a pruned join loses nothing.
    """
    seasons = matches.filter(F.col(ID).isNotNull()).groupBy(ID).agg(F.min(SEASON).alias("_season"))
    agreed = rows.join(seasons, ID, "left").withColumn(SEASON, F.coalesce("_season", SEASON))
    return agreed.select(rows.columns)


def team_stats_of(
    team_stats: DataFrame,
    matches: DataFrame,
    periodo: str | None = None,
    clubs: Sequence[str] | None = None,
    seasons: Sequence[str] | None = None,
) -> DataFrame:
    """Team statistics with match context, opponent and side; pass scoped matches."""
    if periodo is not None:
        team_stats = team_stats.filter(F.col("periodo") == periodo)
    if clubs is not None:
        team_stats = team_stats.filter(F.col("clube").isin(list(clubs)))
        matches = matches_of(matches, clubs)
    club = F.col("clube")
    return _with_match(team_stats, matches, seasons).withColumns(
        {"mando": labels.side_of(club), "adversario": labels.opponent_of(club)}
    )


def player_stats_of(
    player_stats: DataFrame, matches: DataFrame, teams: Sequence[str] | None = None,
    seasons: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of players who were on the pitch, with match context and position names."""
    # Position names come before the join, so that a later semi join on the match id
    # can be pushed down to the player rows.
    played = player_stats.filter(F.col("minutes_played") > 0).withColumn(
        "position", labels.position_name(F.col("position"))
    )
    if teams is not None:
        played = played.filter(F.col("team").isin(list(teams)))
        matches = matches_of(matches, teams)
    return _with_match(played, matches, seasons).withColumn("mando", labels.side_of(F.col("team")))


def team_stats_both_sides(
    team_stats: DataFrame, matches: DataFrame, clubs: Sequence[str],
    seasons: Sequence[str] | None = None,
) -> DataFrame:
    """Both sides' statistics of every match the clubs played."""
    configure(team_stats.sparkSession)  # wide rows are not sorted for the join
    own = in_seasons(team_stats, seasons)
    return own.join(matches_of(matches, clubs).select(ID), ID, "left_semi")
