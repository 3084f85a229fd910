"""Match, side and player labels as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.functions import fixed

DRAW = "Empate"


def is_played(home_goals="gols_casa", away_goals="gols_fora") -> Column:
    """A match counts once both scores are known."""
    return F.col(home_goals).isNotNull() & F.col(away_goals).isNotNull()


def _by_result(home, draw, away) -> Column:
    h, a = F.col("gols_casa"), F.col("gols_fora")
    return F.when(h > a, home).when(a > h, away).when(h == a, draw)


def winner() -> Column:
    return _by_result(F.col("casa"), F.lit(DRAW), F.col("fora"))


def loser() -> Column:
    return _by_result(F.col("fora"), F.lit(DRAW), F.col("casa"))


def total_goals() -> Column:
    return F.col("gols_casa") + F.col("gols_fora")


def winner_odds() -> Column:
    """Decimal odds of the winning side; NULL on a draw."""
    return _by_result(F.col("odd_casa"), F.lit(None), F.col("odd_fora"))


def points(side: str) -> Column:
    """3/1/0 for 'Casa' or 'Fora'."""
    win, loss = (3, 0) if side == "Casa" else (0, 3)
    return _by_result(F.lit(win), F.lit(1), F.lit(loss))


def scoreline() -> Column:
    zero = F.lit(0)
    return F.concat_ws(
        "-",
        F.coalesce("gols_casa", zero).cast("string"),
        F.coalesce("gols_fora", zero).cast("string"),
    )


def side_of(club: Column) -> Column:
    return (
        F.when(club == F.col("casa"), "Casa")
        .when(club == F.col("fora"), "Fora")
        .otherwise("Verificar")
    )


def opponent_of(club: Column) -> Column:
    return F.when(club == F.col("casa"), F.col("fora")).when(
        club == F.col("fora"), F.col("casa")
    )


def goals_for(club: Column) -> Column:
    return F.when(club == F.col("casa"), F.col("gols_casa")).when(
        club == F.col("fora"), F.col("gols_fora")
    )


def goals_against(club: Column) -> Column:
    return F.when(club == F.col("casa"), F.col("gols_fora")).when(
        club == F.col("fora"), F.col("gols_casa")
    )


def analysed_clubs(*clubs: str) -> Column:
    """Array of those analysed clubs that took part; explode it, so that a match
    between two analysed clubs gives a row for each of them."""
    both = F.array(*[F.lit(c) for c in clubs])
    return F.filter(both, lambda c: (c == F.col("casa")) | (c == F.col("fora")))


def position_name(code: Column) -> Column:
    out = F
    for letter, name in fixed.POSITIONS:
        out = out.when(code == letter, name)
    return out.otherwise("Verificar")


def position_order(name: Column) -> Column:
    """Goalkeeper first, forward last, anything unknown at the end."""
    out = F
    for place, (_, label) in enumerate(fixed.POSITIONS, start=1):
        out = out.when(name == label, place)
    return out.otherwise(len(fixed.POSITIONS) + 1)


def goal_involvement() -> Column:
    return F.coalesce("goals", F.lit(0)) + F.coalesce("goal_assist", F.lit(0))


def age_in_years(birth_epoch: Column, as_of: Column) -> Column:
    """Completed years between an epoch-second birth date and ``as_of``."""
    born = F.timestamp_seconds(birth_epoch).cast("date")
    return F.floor(F.datediff(as_of, born) / F.lit(365.25)).cast("int")


def odds_band(odds: Column) -> Column:
    """Struct (ordem, faixa) of the right-closed band; NULL below the first edge."""
    edges, names = fixed.ODDS_BAND_EDGES, fixed.ODDS_BAND_NAMES
    value = odds.cast("decimal(12,2)")
    out = F
    for place, name in enumerate(names, start=1):
        band = F.struct(F.lit(place).alias("ordem"), F.lit(name).alias("faixa"))
        upper = edges[place] if place < len(edges) else None
        inside = F.lit(True) if upper is None else value <= F.lit(upper).cast("decimal(12,2)")
        out = out.when((value >= F.lit(edges[0]).cast("decimal(12,2)")) & inside, band)
    return out
