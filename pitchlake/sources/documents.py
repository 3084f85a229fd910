"""Landed JSON documents -> rows: events, team statistics, line-ups, goals.

Each function takes a frame with the document text in ``doc`` (and the match
context it needs) and stays inside the JVM: ``from_json``, array functions and
``explode``; no document is ever grouped with another. The parsed arrays go through
``posexplode_outer`` and a filter, because a plain explode makes Spark add a
not-empty test that parses every document twice. Repeated metrics are left to the map
builder (``session.configure`` lets the last value of a key win), so no array is searched.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.functions import text
from pitchlake.operators import naming
from pitchlake.session import configure

RATING_KEY = "ratingVersions"


def flatten_events(
    docs: DataFrame, club_names: DataFrame | None = None, competitions: DataFrame | None = None
) -> DataFrame:
    """Event documents -> match rows with standard names.

    Other columns of ``docs`` (season, country, odds) are carried along.
    """
    carried = [c for c in docs.columns if c != "doc"]
    e = docs.withColumn("_e", F.from_json("doc", schemas.EVENT_DOC))
    rows = e.select(
        *carried,
        F.col("_e.id").alias("id_jogo"),
        text.local_date(F.col("_e.startTimestamp")).alias("data"),
        text.local_time(F.col("_e.startTimestamp")).alias("hora"),
        F.col("_e.tournament.name").alias("campeonato"),
        text.round_number(F.col("_e.roundInfo.name"), F.col("_e.roundInfo.round")).alias("rodada"),
        F.col("_e.homeTeam.id").alias("casa_id"),
        F.trim("_e.homeTeam.name").alias("casa"),
        F.col("_e.awayTeam.id").alias("fora_id"),
        F.trim("_e.awayTeam.name").alias("fora"),
        score(F.col("_e.homeScore")).alias("gols_casa"),
        score(F.col("_e.awayScore")).alias("gols_fora"),
    )
    rows = naming.standard_competition(rows, "campeonato", competitions)
    if club_names is not None:
        rows = naming.standard_club(rows, club_names, "casa_id", "casa")
        rows = naming.standard_club(rows, club_names, "fora_id", "fora")
    return rows


def score(c: Column) -> Column:
    """Normal-time score, else the current one, else 0."""
    return F.coalesce(c["normaltime"], c["current"], F.lit(0))


def _side_map(entries: Column, side: str) -> Column:
    return F.map_from_entries(
        F.transform(entries, lambda x: F.struct(x["key"].alias("key"), x[side].alias("value")))
    )


def flatten_team_stats(docs: DataFrame) -> DataFrame:
    """(id_jogo, casa, fora, temporada, doc) -> two rows per period with a metric map.

    A period without groups gives no rows; of a repeated metric the last value stays.
    """
    configure(docs.sparkSession)
    context = ["id_jogo", "casa", "fora", "temporada"]
    parsed = docs.select(*context, F.from_json("doc", schemas.STATISTICS_DOC)["statistics"].alias("s"))
    periods = parsed.select(
        *context, F.transform("s", lambda p: p["period"]).alias("names"), F.posexplode_outer("s")
    ).filter(F.array_position("names", F.col("col.period")) == F.col("pos") + 1)
    items = F.flatten(F.transform("col.groups", lambda g: F.coalesce(
        g["statisticsItems"], F.array().cast("array<struct<name:string,home:string,away:string>>"))))
    entries = F.transform(
        items,
        lambda it: F.struct(
            text.metric_column(it["name"]).alias("key"),
            it["home"].alias("home"),
            it["away"].alias("away"),
        ),
    )
    rows = periods.filter(F.size("col.groups") > 0).select(
        *context, F.col("col.period").alias("periodo"), entries.alias("items")
    )
    sides = F.array(
        F.struct(F.col("casa").alias("clube"), _side_map(F.col("items"), "home").alias("metricas")),
        F.struct(F.col("fora").alias("clube"), _side_map(F.col("items"), "away").alias("metricas")),
    )
    return rows.select("id_jogo", "temporada", "periodo", F.explode(sides).alias("l")).select(
        "id_jogo", "periodo", F.col("l.clube").alias("clube"), "temporada",
        F.col("l.metricas").alias("metricas"),
    )


def widen(rows: DataFrame, schema, map_column: str = "metricas") -> DataFrame:
    """Metric map -> the declared wide schema; metrics the map lacks stay NULL."""
    plain = set(rows.columns)
    return rows.select([
        (
            F.col(f.name)
            if f.name in plain
            else text.number(F.try_element_at(map_column, F.lit(f.name)), f.dataType.simpleString())
            if f.dataType.simpleString() in text.INTEGERS
            else F.try_element_at(map_column, F.lit(f.name)).try_cast(f.dataType)
        ).alias(f.name)
        for f in schema.fields
    ])


def flatten_lineups(docs: DataFrame) -> DataFrame:
    """(id_jogo, casa, fora, temporada, doc) -> one row per player with a metric map.

    Of two keys with one name the last value stays.
    """
    configure(docs.sparkSession)
    parsed = docs.select(
        "id_jogo", "casa", "fora", "temporada", F.from_json("doc", schemas.LINEUPS_DOC).alias("d")
    )
    squad = lambda side, team: F.struct(F.col(team).alias("team"), F.col(f"d.{side}.players").alias("players"))
    sides = parsed.select("id_jogo", "temporada", F.explode(F.array(squad("home", "casa"), squad("away", "fora"))).alias("t"))
    rows = sides.select("id_jogo", "temporada", "t.team", F.explode("t.players").alias("p")).select(
        "id_jogo", "temporada", "team", "p.*"
    )
    stats = F.map_filter("statistics", lambda k, v: k != RATING_KEY)
    metrics = F.transform_keys(stats, lambda k, v: text.snake_case(k))
    rating = F.coalesce(
        F.try_element_at("statistics", F.lit("rating")),
        F.get_json_object(F.try_element_at("statistics", F.lit(RATING_KEY)), "$.original"),
    )
    return rows.select(
        "id_jogo", "team",
        F.col("player.id").alias("player_id"),
        F.col("player.name").alias("name"),
        F.col("player.position").alias("position"),
        text.number(F.col("player.jerseyNumber"), "int").alias("jersey_number"),
        F.col("player.height").alias("height"),
        F.col("player.dateOfBirthTimestamp").alias("date_of_birth_timestamp"),
        F.col("player.country.name").alias("country"),
        F.col("player.proposedMarketValueRaw.value").cast("decimal(18,2)").alias("value"),
        "substitute", "captain",
        rating.try_cast("double").alias("rating"),
        "temporada",
        metrics.alias("metricas"),
    )


def incident_score(c: Column) -> Column:
    """Display field of a score object, else the scalar itself, else 0 (as text)."""
    scalar = F.when(~c.startswith("{"), c)
    return F.coalesce(F.get_json_object(c, "$.display"), scalar, F.lit("0"))


def flatten_goals(docs: DataFrame) -> DataFrame:
    """(id_jogo, casa, fora, temporada, campeonato, doc) -> one row per goal, in order.

    The first goal action of an incident gives side, minute and body part; without
    an action list the incident's own fields do. A list without a goal gives no row.
    """
    context = ["id_jogo", "casa", "fora", "temporada", "campeonato"]
    parsed = docs.select(*context, F.from_json("doc", schemas.INCIDENTS_DOC)["incidents"].alias("i"))
    goals = parsed.select(*context, F.posexplode_outer("i").alias("ordem", "g")).filter(
        F.col("g.incidentType") == "goal"
    )
    actions = F.col("g.footballPassingNetworkAction")
    scored = F.filter(
        actions, lambda a: F.coalesce(a["eventType"], F.col("g.incidentType")) == "goal"
    )
    first = goals.withColumn("a", F.try_element_at(scored, F.lit(1))).filter(
        (F.coalesce(F.size(actions), F.lit(0)) <= 0) | F.col("a").isNotNull()
    )
    is_home = F.coalesce(F.col("a.isHome"), F.col("g.isHome"), F.lit(False))
    return first.select(
        "id_jogo", "temporada", "campeonato",
        F.when(is_home, F.col("casa")).otherwise(F.col("fora")).alias("clube_gol"),
        F.coalesce("a.time", "g.time", F.lit(0)).alias("minutos"),
        F.coalesce("a.bodyPart", "g.bodyPart", F.lit("")).alias("forma_gol"),
        F.concat_ws(
            "-", incident_score(F.col("g.homeScore")), incident_score(F.col("g.awayScore"))
        ).alias("placar"),
        "ordem",
    )
