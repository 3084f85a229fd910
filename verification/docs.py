"""Source documents and files written from the given tables, for the ingestion queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.session import shared_dir
from verification import views

COMPETITIONS = ["Brasileirão Betano, Rodada 1", " LaLiga ", "Copa X", "UEFA Champions League"]


def pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def kickoff():
    """Epoch seconds: the order's date plus a time of day that crosses midnight at UTC-3."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return day.cast("bigint") * 86400 + F.col("o_orderkey") * 977 % 86400


def event_struct():
    key = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    name = F.when(key % 3 == 0, F.concat(F.lit("Rodada "), (key % 38).cast("string")))
    return F.struct(
        key.alias("id"),
        kickoff().alias("startTimestamp"),
        F.struct(pick(COMPETITIONS, key % 4).alias("name")).alias("tournament"),
        F.struct(name.alias("name"), F.when(key % 5 != 0, key % 20).alias("round")).alias("roundInfo"),
        F.struct((F.col("o_custkey") % 25).alias("id"),
                 F.concat(F.lit(" Club "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("name")
                 ).alias("homeTeam"),
        F.struct((F.col("o_custkey") % 25 + 30).alias("id"), F.lit("Visitor").alias("name")
                 ).alias("awayTeam"),
        F.struct(F.when(key % 2 == 0, cents % 6).alias("normaltime"),
                 F.when(key % 7 != 0, cents % 5).alias("current")).alias("homeScore"),
        F.struct((cents % 4).alias("normaltime"), (cents % 3).alias("current")).alias("awayScore"),
    )


def landed(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores, as documents land in many files and not in one row group."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def event_docs(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "orders").select(F.to_json(event_struct()).alias("doc"))


def club_names(spark: SparkSession, sf: str) -> DataFrame:
    """Club dictionary: the nations with even keys."""
    n = views.table(spark, sf, "nation")
    return n.filter(F.col("n_nationkey") % 2 == 0).select(
        F.col("n_nationkey").cast("bigint").alias("club_id"), F.col("n_name").alias("nome"))


def statistics_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Two periods; 'Big chances' comes twice (last wins); every 7th match has no second half."""
    key = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")

    def item(label, home, away):
        return F.struct(F.lit(label).alias("name"), home.cast("string").alias("home"),
                        away.cast("string").alias("away"))

    def period(code, add):
        pct = F.concat((30 + cents % 41).cast("string"), F.lit("%"))
        group1 = F.struct(F.array(item("Ball possession", pct, pct),
                                  item("Big chances", cents % 3, cents % 4)).alias("statisticsItems"))
        group2 = F.struct(F.array(item("Big chances", (cents + add) % 9, (cents + add) % 8),
                                  item("Fouled (in final third)", key % 5, key % 6)
                                  ).alias("statisticsItems"))
        return F.struct(F.lit(code).alias("period"), F.array(group1, group2).alias("groups"))

    first, second = period("1ST", 1), period("2ND", 2)
    both = F.when(key % 7 == 0, F.array(first)).otherwise(F.array(first, second))
    return landed(views.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")).select(
        key.alias("id_jogo"), F.lit("Home FC").alias("casa"), F.lit("Away FC").alias("fora"),
        F.year("o_orderdate").cast("string").alias("temporada"),
        F.to_json(F.struct(both.alias("statistics"))).alias("doc"))


def _field(name: str, value, quoted: bool = False):
    """A field of a JSON object as text, NULL where its value is NULL; the values here need no escapes."""
    mark = '"' if quoted else ""
    return F.concat(F.lit(f'"{name}":{mark}'), value.cast("string"), F.lit(mark))


def _object(*fields):
    """A JSON object as text, without the fields that are NULL, as ``to_json`` writes it."""
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def lineup_docs(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """Every statistics object has 'keyPass' under a second name first: the last value stays.

    The text is joined from its parts, which takes a fraction of ``to_json`` over nested structs; the
    generator after it keeps a JSON reader from taking the parts in, which would run them interpreted.
    """
    line = F.col("l_linenumber")
    qty = F.col("l_quantity").cast("int")
    stats = _object(
        _field("minutesPlayed", F.concat(qty.cast("string"), F.lit(".0")), True), _field("goals", qty % 3),
        _field("bigChanceCreated", qty % 5), F.lit('"key_pass":99'), _field("keyPass", qty % 7),
        _field("ratingVersions", _object(_field("original", F.lit(50) + qty % 50))))

    def player(add):
        return _object(
            _field("player", _object(
                _field("id", F.col("l_partkey") + add),
                _field("name", F.concat(F.lit("P"), F.col("l_partkey").cast("string")), True),
                # compiled, element_at takes a NULL index for some element of a list without NULLs
                _field("position", F.when(line.isNotNull(), pick(["G", "D", "M", "F"], line % 4)), True),
                _field("jerseyNumber", line + add, True),
                _field("height", 170 + line),
                F.lit('"country":{"name":"Brazil"}'),
            )),
            _field("substitute", line > 4), _field("captain", line == 1), _field("statistics", stats))

    def side(name, *players):
        return F.concat(F.lit(f'"{name}":{{"players":['), F.concat_ws(",", *players), F.lit("]}"))

    lines = views.table(spark, sf, "lineitem") if lines is None else lines
    return landed(lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")).select(
        F.col("l_orderkey").alias("id_jogo"), F.lit("Home FC").alias("casa"),
        F.lit("Away FC").alias("fora"), F.lit("2025").alias("temporada"),
        _object(side("home", player(0), player(1)), side("away", player(2))).alias("doc")).select(
        "*", F.explode(F.array(F.lit(0))).alias("_")).drop("_")


def incident_docs(spark: SparkSession, sf: str) -> DataFrame:
    """A card, a goal with actions, a goal without, and a goal whose actions hold none."""
    key = F.col("event_id")
    action = "struct<eventType:string,isHome:boolean,time:int,bodyPart:string>"
    kind = "struct<incidentType:string,homeScore:string,awayScore:string,isHome:boolean," \
           f"time:int,bodyPart:string,footballPassingNetworkAction:array<{action}>>"

    def act(code, home, time, body):
        return F.struct(F.lit(code).alias("eventType"), home.alias("isHome"),
                        time.cast("int").alias("time"), F.lit(body).alias("bodyPart"))

    def incident(code, time, body, actions):
        return F.struct(
            F.lit(code).alias("incidentType"), (key % 4).cast("string").alias("homeScore"),
            F.when(key % 6 != 0, (key % 3).cast("string")).alias("awayScore"),
            (key % 2 == 0).alias("isHome"), time.cast("int").alias("time"),
            F.lit(body).alias("bodyPart"), actions.alias("footballPassingNetworkAction")).cast(kind)

    none = F.lit(None).cast(f"array<{action}>")
    passes = F.array(act("pass", key % 3 == 0, key % 50, "head"))
    scored = F.array(act("pass", key % 3 == 0, key % 50, "head"),
                     act("goal", key % 3 == 0, key % 90, "left-foot"))
    incidents = F.array(
        incident("card", key % 90, "", none), incident("goal", key % 80, "head", scored),
        incident("goal", key % 70, "right-foot", none), incident("goal", key % 60, "x", passes))
    return views.table(spark, sf, "events").select(
        key.alias("id_jogo"), F.lit("Home FC").alias("casa"), F.lit("Away FC").alias("fora"),
        F.lit("2024").alias("temporada"), F.lit("Copa").alias("campeonato"),
        F.to_json(F.struct(incidents.alias("incidents"))).alias("doc"))


def write_csv(df: DataFrame, name: str, **options) -> str:
    path = shared_dir(df.sparkSession, name)
    writer = df.write
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.csv(path)
    return path


def write_lines(df: DataFrame, name: str) -> str:
    path = shared_dir(df.sparkSession, name)
    df.write.text(path)
    return path
