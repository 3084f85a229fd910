"""Player leaderboards, probable line-ups, formations, squad age and value, goal timing.

All operators take rows from ``sources.tables.player_stats_of`` (players who were
on the pitch, with match date). A player is the key (player_id, name, position,
team), so namesakes and players who moved stay apart.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions import labels
from pitchlake.functions.numeric import count_if, exact, mean, ratio, total
from pitchlake.operators.club_games import last_n, top_per_group
from pitchlake.session import materialise

PLAYER = ("player_id", "name", "position", "team")


def recent_games(
    players: DataFrame, n: int = 10, by: Sequence[str] = ("team",)
) -> DataFrame:
    """Keys of each team's last n games that have at least one row in ``players``."""
    games = players.groupBy(*by, "id_jogo").agg(
        F.max("data").alias("data"), F.max("hora").alias("hora")
    )
    return last_n(games, n, by).select(*by, "id_jogo")


def in_recent_games(
    players: DataFrame, n: int = 10, by: Sequence[str] = ("team",)
) -> DataFrame:
    """Player rows of each team's last n games.

    The game list has at most n rows per team. It is written once to the shared
    folder, so Spark knows its size and broadcasts a small list; a large one is
    joined by shuffle. Pass the result to several leaderboards to find it only once.
    """
    games = materialise(recent_games(players, n, by), "recent-games")
    return players.join(games, [*by, "id_jogo"], "left_semi")


def measure(metric: str, how: str = "sum") -> Column:
    """Aggregate of one player metric; 'participacao' is goals plus assists."""
    value = labels.goal_involvement() if metric == "participacao" else F.col(metric)
    if how == "mean":
        return mean(value)
    if metric in ("rating", "expected_goals"):
        return F.round(F.coalesce(F.sum(exact(value)), F.lit(0)), 2).cast("double")
    return total(value)


def totals(
    players: DataFrame,
    metric: str,
    how: str = "sum",
    by: Sequence[str] = PLAYER,
    with_minutes: bool = False,
) -> DataFrame:
    """``valor`` of one metric for each player (and minutes for minimum rules)."""
    named = players.filter(F.col("name").isNotNull() & F.col("position").isNotNull())
    extra = [total(F.col("minutes_played")).alias("minutos")] if with_minutes else []
    return named.groupBy(*by).agg(measure(metric, how).alias("valor"), *extra)


def leaders(
    table: DataFrame,
    k: int = 10,
    per: Sequence[str] = (),
    above: float | None = None,
    min_minutes: int | None = None,
) -> DataFrame:
    """Top k by ``valor``, over all rows or inside each ``per`` group; ties by name and id."""
    if above is not None:
        table = table.filter(F.col("valor") > above)
    if min_minutes is not None:
        table = table.filter(F.col("minutos") >= min_minutes)
    order = [F.col("valor").desc_nulls_last(), F.col("name"), F.col("player_id")]
    order += [F.col(c) for c in ("position", "team") if c in table.columns]
    if not per:
        return table.orderBy(*order).limit(k)
    return top_per_group(table, k, per, order, "posicao")


OVERALL = "Geral"


def leader_lists(
    players: DataFrame, metrics: Sequence[str], k: int = 10, by: Sequence[str] = (),
    key: Sequence[str] = ("player_id", "name"),
) -> DataFrame:
    """Top k of every metric, overall and by position, from one pass over the rows.

    Grouping sets total a player at each position and over all of them in one Expand and one
    shuffle, whose map side adds up first; ``grouping_id`` tells the lists apart, so a position
    that is missing is no list of its own. ``lista`` is the position or 'Geral'; ties go by
    name and id.
    """
    by, key = list(by), list(key)
    named = players.filter(F.col("name").isNotNull() & F.col("position").isNotNull())
    used = named.select(*by, *key, "position", *[
        (labels.goal_involvement() if m == "participacao" else F.col(m)).alias(m) for m in metrics])
    sums = used.groupingSets([[*by, *key, "position"], [*by, *key]], *by, *key, "position").agg(
        F.grouping_id().alias("_set"), *[measure_of(m).alias(m) for m in metrics])
    lists = sums.select(
        *by, *key, F.when(F.col("_set") == 0, F.col("position")).otherwise(OVERALL).alias("lista"),
        F.explode(F.create_map(*[x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))])).alias("metrica", "valor"))
    order = [F.col("valor").desc_nulls_last(), F.col("name"), F.col("player_id")]
    return top_per_group(lists.filter(F.col("valor") > 0), k, [*by, "metrica", "lista"], order, "posicao")


def measure_of(metric: str) -> Column:
    """Sum of a column that holds the metric."""
    return total(F.col(metric)) if metric == "participacao" else measure(metric)


def with_teams(players: DataFrame, metric: str, extra: Sequence[str] = ()) -> DataFrame:
    """Total of a metric per player over all teams, with the team names as 'A, B'."""
    named = players.filter(F.col("name").isNotNull() & F.col("position").isNotNull())
    return named.groupBy(*extra, "player_id", "name", "position").agg(
        F.concat_ws(", ", F.array_sort(F.collect_set("team"))).alias("team"),
        measure(metric).alias("valor"),
    )


def regulars(
    players: DataFrame,
    metric: str,
    share: float = 0.40,
    within: Sequence[str] = ("campeonato",),
) -> DataFrame:
    """Mean of a metric for players with at least ``share`` of the most minutes played.

    Minutes are counted per player and team. The totals are written once and read
    for both the highest total of each ``within`` group and the filter.
    """
    table = materialise(
        totals(players, metric, "mean", [*within, *PLAYER], with_minutes=True), "player-totals"
    )
    # Few groups: their known size lets Spark broadcast them, so no group's players meet in one task.
    most = materialise(table.groupBy(*within).agg(F.max("minutos").alias("_most")), "most-minutes")
    enough = F.col("minutos") * 100 >= F.col("_most") * F.lit(round(share * 100))
    return table.join(most, list(within)).filter(enough).drop("_most")


def probable_lineup(
    players: DataFrame, n: int = 10, size: int = 11, by: Sequence[str] = ("team",)
) -> DataFrame:
    """The players who started most of the team's last n games, goalkeeper first."""
    starters = players.filter(~F.col("substitute"))
    starts = (
        in_recent_games(starters, n, by)
        .groupBy(*dict.fromkeys([*by, *PLAYER]))
        .agg(F.count(F.lit(1)).alias("jogos_titular"))
    )
    first = [
        F.col("jogos_titular").desc(), F.col("name"), F.col("player_id"), F.col("position"),
    ]
    return top_per_group(starts, size, by, first).withColumn(
        "ordem", labels.position_order(F.col("position"))
    )


def formation(lineup: DataFrame, by: Sequence[str] = ("team",)) -> DataFrame:
    """'defenders-midfielders-forwards' of a line-up."""

    def line(name: str) -> Column:
        return count_if(F.col("position") == name).cast("string")

    return lineup.groupBy(*by).agg(
        F.concat_ws("-", line("Defensor"), line("Meio-campo"), line("Atacante")).alias("formacao")
    )


def core_squad(players: DataFrame, size: int = 11, by: Sequence[str] = ("team",)) -> DataFrame:
    """The most used players of each team, with birth date and market value."""
    used = (
        players.filter(F.col("name").isNotNull() & F.col("position").isNotNull())
        .groupBy(*dict.fromkeys([*by, *PLAYER]))
        .agg(
            total(F.col("minutes_played")).alias("minutos"),
            F.max("date_of_birth_timestamp").alias("date_of_birth_timestamp"),
            F.max("value").alias("value"),
        )
    )
    order = [F.col("minutos").desc(), F.col("name"), F.col("player_id"), F.col("position")]
    return top_per_group(used, size, by, order)


def squad_age_and_value(
    players: DataFrame, as_of, size: int = 11, by: Sequence[str] = ("team",)
) -> DataFrame:
    """Mean age and mean market value of the most used players."""
    born, today = F.col("date_of_birth_timestamp"), F.lit(str(as_of)).cast("date")
    squad = core_squad(players, size, by).withColumn("idade", labels.age_in_years(born, today))
    return squad.groupBy(*by).agg(
        mean(F.col("idade")).alias("idade_media"), mean(F.col("value")).alias("valor_medio")
    )


def score_timeline(goals: DataFrame, matches: DataFrame, whistle: int = 90) -> DataFrame:
    """(id_jogo, casa, fora, inicio, fim, gols_casa, gols_fora): the score between its changes.

    Goals of one minute change it together, so no interval is empty. The first begins at 0, the
    last ends at the whistle or, after goals in added time, one minute after the last of them.
    Played matches without goals have one interval. Goals of neither club, without a minute or
    before 0 change nothing. Only a match's own changes meet in a window.
    """
    games = matches.select("id_jogo", "casa", "fora")
    scored = goals.filter("minutos >= 0").select("id_jogo", "clube_gol", "minutos").join(
        games, "id_jogo").filter(F.col("clube_gol").isin(F.col("casa"), F.col("fora")))
    at_home = F.when(F.col("clube_gol") == F.col("casa"), 1).otherwise(0)
    changes = scored.select("id_jogo", F.col("minutos").alias("inicio"), at_home.alias("c"), (1 - at_home).alias("f"))
    starts = games.select("id_jogo", F.lit(0).alias("inicio"), F.lit(0).alias("c"), F.lit(0).alias("f"))
    minutes = changes.unionByName(starts).groupBy("id_jogo", "inicio").agg(F.sum("c").alias("c"), F.sum("f").alias("f"))
    w = Window.partitionBy("id_jogo").orderBy("inicio")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.coalesce(F.lead("inicio").over(w), F.greatest(F.lit(whistle), F.col("inicio") + 1))
    spans = minutes.select("id_jogo", "inicio", end.cast("int").alias("fim"), F.sum("c").over(so_far).alias("gols_casa"),
                           F.sum("f").over(so_far).alias("gols_fora"))
    return spans.join(games, "id_jogo").select(
        "id_jogo", "casa", "fora", "inicio", "fim", F.col("gols_casa").cast("int").alias("gols_casa"),
        F.col("gols_fora").cast("int").alias("gols_fora"))


STATES = {"vencendo": 1, "empatando": 0, "perdendo": -1}


def _state(own: Column, other: Column) -> Column:
    return F.when(own > other, "vencendo").when(own < other, "perdendo").otherwise("empatando")


def minutes_by_state(timeline: DataFrame) -> DataFrame:
    """(clube, jogos, minutos, vencendo, empatando, perdendo): minutes led, level and behind."""
    side = lambda club, own, other: F.struct(F.col(club).alias("clube"), _state(F.col(own), F.col(other)).alias("estado"))
    sides = timeline.select("id_jogo", (F.col("fim") - F.col("inicio")).alias("m"), F.explode(F.array(
        side("casa", "gols_casa", "gols_fora"), side("fora", "gols_fora", "gols_casa"))).alias("s"))
    per_game = sides.groupBy(F.col("s.clube").alias("clube"), "id_jogo").agg(
        F.sum("m").alias("m"), *[F.sum(F.when(F.col("s.estado") == s, F.col("m")).otherwise(0)).alias(s) for s in STATES])
    return per_game.groupBy("clube").agg(
        F.count(F.lit(1)).alias("jogos"), F.sum("m").alias("minutos"), *[F.sum(s).alias(s) for s in STATES])


def at_score(events: DataFrame, timeline: DataFrame, minute: str = "minutos", club: str | None = None) -> DataFrame:
    """Events with the score in whose interval their minute lies, and the state of their club.

    A range join inside the equi join on the match id: only a match's few intervals are compared. A
    goal lies at the start of the interval it makes; subtract a minute for the score before it.
    """
    spans = timeline.select("id_jogo", "inicio", "fim", "casa", "fora", "gols_casa", "gols_fora")
    inside = (events["id_jogo"] == spans["id_jogo"]) & (events[minute] >= spans["inicio"]) & (events[minute] < spans["fim"])
    found = events.join(spans, inside).drop(spans["id_jogo"])
    if club is None:
        return found
    home, own, other = F.col(club) == F.col("casa"), F.col("gols_casa"), F.col("gols_fora")
    return found.withColumn("estado", F.when(home, _state(own, other)).when(F.col(club) == F.col("fora"), _state(other, own)))


def goals_by_interval(
    goals: DataFrame, minutes: int = 15, by: Sequence[str] = ("clube_gol",)
) -> DataFrame:
    """Goals of each club in each interval of the match, with its share."""
    start = (F.floor(F.col("minutos") / minutes) * minutes).cast("int")
    counts = goals.filter(F.col("minutos").isNotNull()).groupBy(*by, start.alias("inicio")).agg(
        F.count(F.lit(1)).alias("gols")
    )
    whole = counts.groupBy(*by).agg(F.sum("gols").alias("_all"))
    return (
        counts.join(whole, list(by))
        .withColumn("perc", ratio(F.col("gols"), F.col("_all"), factor=100))
        .drop("_all")
    )
