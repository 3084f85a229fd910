"""Metrics that nobody declared: bronze documents as VARIANT, a catalogue of labels, wider schemas.

A source may send a new metric any day. The bronze table keeps each document whole, parsed once
into a VARIANT; ``team_metrics`` and ``player_metrics`` read from it every metric as a row,
with its own label and its value as it was sent (number or text). ``catalogue`` lists all labels
with what their values can be, in one aggregate, so nothing needs to be known before;
``against`` compares it with a wide schema. ``widened`` adds the labels one asks for, and
``wide`` lays the rows out by any such schema. A label that is in none stays in bronze and in
the rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.functions import text
from pitchlake.sources.documents import RATING_KEY

CONTEXT = ("id_jogo", "casa", "fora", "temporada")
#: Field names under which a document's parts are read; the leaves stay VARIANT.
_TEAM = ("array<struct<period: string, groups: array<struct<statisticsItems: "
         "array<struct<name: string, home: variant, away: variant>>>>>>")
_SQUAD = "array<struct<player: struct<id: bigint, name: string>, statistics: variant>>"
DECLARED, NEW, ABSENT = "declarada", "nova", "ausente"


def bronze(docs: DataFrame) -> DataFrame:
    """Documents with ``doc`` as VARIANT; ``linha`` keeps the text of those that are no JSON."""
    parsed = F.try_parse_json("doc")
    return docs.withColumns({"doc": parsed, "linha": F.when(parsed.isNull(), F.col("doc"))})



def team_metrics(docs: DataFrame) -> DataFrame:
    """Bronze statistics -> (id_jogo, temporada, periodo, clube, rotulo, metrica, valor, ordem).

    A period that comes twice counts once, the first time.
    """
    periods = docs.select(*CONTEXT, F.try_variant_get("doc", "$.statistics", _TEAM).alias("p")).select(
        *CONTEXT, F.transform("p", lambda p: p["period"]).alias("names"), F.posexplode_outer("p")
    ).filter(F.array_position("names", F.col("col.period")) == F.col("pos") + 1)
    items = F.flatten(F.transform("col.groups", lambda g: F.coalesce(
        g["statisticsItems"], F.array().cast("array<struct<name: string, home: variant, away: variant>>"))))
    rows = periods.select("id_jogo", "temporada", F.col("col.period").alias("periodo"), "casa", "fora",
                          F.posexplode_outer(items).alias("ordem", "item")).filter("item IS NOT NULL")
    rows = rows.select("id_jogo", "temporada", "periodo", "ordem", F.col("item.name").alias("rotulo"), F.array(
        F.struct(F.col("casa").alias("clube"), F.col("item.home").alias("valor")),
        F.struct(F.col("fora").alias("clube"), F.col("item.away").alias("valor"))).alias("lados"))
    return rows.select("id_jogo", "temporada", "periodo", "ordem", "rotulo", F.explode("lados").alias("l")).select(
        "id_jogo", "temporada", "periodo", F.col("l.clube").alias("clube"), "rotulo",
        text.metric_column(F.col("rotulo")).alias("metrica"), F.col("l.valor").alias("valor"), "ordem")


def player_metrics(docs: DataFrame) -> DataFrame:
    """Bronze line-ups -> (id_jogo, temporada, team, player_id, name, rotulo, metrica, valor, ordem)."""
    squad = lambda path, team: F.struct(
        F.col(team).alias("team"), F.try_variant_get("doc", path, _SQUAD).alias("players"))
    sides = docs.select(*CONTEXT, F.explode(F.array(squad("$.home.players", "casa"), squad("$.away.players", "fora"))).alias("t"))
    players = sides.select("id_jogo", "temporada", "t.team", F.explode("t.players").alias("p")).select(
        "id_jogo", "temporada", "team", F.col("p.player.id").alias("player_id"), F.col("p.player.name").alias("name"),
        F.col("p.statistics").alias("_s"))
    # A value is cut out of its object as it lies there; a map of them would build each anew.
    rows = players.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("_s").outer()))
    return rows.filter(F.col("key") != RATING_KEY).select(
        "id_jogo", "temporada", "team", "player_id", "name", F.col("key").alias("rotulo"),
        text.snake_case(F.col("key")).alias("metrica"), F.col("value").alias("valor"), F.col("pos").alias("ordem"))


def plain(value: Column) -> Column:
    """A VARIANT scalar as text, a JSON null as NULL; JSON text of anything else."""
    return F.when(~F.is_variant_null(value), F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))


def catalogue(metrics: DataFrame) -> DataFrame:
    """Every metric that came: labels, rows, filled rows, and the narrowest type of all its values.

    Equal values of a label are counted first, so a value is read as a number once for each task
    that holds it and not in each row; a row for each metric at the end.
    """
    json = F.col("_json")
    counted = metrics.groupBy("metrica", "rotulo", F.to_json("valor").alias("_json")).agg(F.count(F.lit(1)).alias("r"))
    sent_as = F.try_parse_json(json)  # an infinite number is no JSON
    value = F.trim(F.when(sent_as.isNull(), json).otherwise(plain(sent_as)))
    sent = F.when(~value.isin(""), value)
    number = sent.try_cast("double")
    whole = number.isNotNull() & (sent.try_cast("decimal(38,10)").cast("bigint").cast("double") == number)
    seen = counted.select("metrica", "rotulo", "r", sent.alias("v"), number.alias("n"), whole.alias("w"))
    rows = lambda which: F.coalesce(F.sum(F.when(which, F.col("r"))), F.lit(0))
    filled = rows(F.col("v").isNotNull())
    kind = (
        F.when(filled == 0, None)
        .when(rows(F.col("w")) == filled, F.when(F.max(F.abs("n")) < float(1 << 31), "int").otherwise("bigint"))
        .when(rows(F.col("n").isNotNull()) == filled, "double")
        .otherwise("string")
    )
    return seen.groupBy("metrica").agg(
        F.array_sort(F.collect_set("rotulo")).alias("rotulos"), rows(F.lit(True)).alias("linhas"),
        filled.alias("preenchidas"), kind.alias("tipo"))


def against(found: DataFrame, schema: T.StructType, keys: Sequence[str] = ()) -> DataFrame:
    """The catalogue beside a wide schema: declared, new, or declared and absent.

    ``cabe`` is false where values came that the declared type cannot hold.
    """
    spark = found.sparkSession
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name not in keys]
    declared = spark.createDataFrame(rows, "metrica string, declarado string")  # a row for each column
    both = found.join(declared, "metrica", "full")
    state = F.when(F.col("declarado").isNull(), NEW).when(F.col("linhas").isNull(), ABSENT).otherwise(DECLARED)
    order = {"int": 1, "bigint": 2, "double": 3, "string": 4}
    rank = lambda c: F.coalesce(*[F.when(c == k, v) for k, v in order.items()])
    fits = F.when(state == DECLARED, F.coalesce(rank(F.col("tipo")) <= rank(F.col("declarado")), F.lit(True)))
    return both.select("metrica", "rotulos", F.coalesce("linhas", F.lit(0)).alias("linhas"),
                       F.coalesce("preenchidas", F.lit(0)).alias("preenchidas"), "tipo", "declarado",
                       state.alias("situacao"), fits.alias("cabe"))


def widened(schema: T.StructType, found: DataFrame, labels: Sequence[str] | None = None) -> T.StructType:
    """The schema with new metrics of the catalogue (all, or those named) at its end, by name.

    A metric that never had a value is kept as text.
    """
    known = {f.name for f in schema.fields}
    rows = found.filter(~F.col("metrica").isin(sorted(known))) if known else found
    if labels is not None:
        rows = rows.filter(F.col("metrica").isin(list(labels)))
    new = sorted((r["metrica"], r["tipo"] or "string") for r in rows.select("metrica", "tipo").collect())  # a row for each label
    wanted = set(labels or ()) - known - {m for m, _ in new}
    if wanted:
        raise ValueError(f"no such metrics: {sorted(wanted)}")
    kinds = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
    return T.StructType([*schema.fields, *[T.StructField(m, kinds[k]) for m, k in new]])


def wide(metrics: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Metric rows -> one row for each key with the schema's columns; the last value of a metric stays.

    One aggregate; a metric's value and its place are compared as they pass, so no group is held.
    """
    own = [f for f in schema.fields if f.name not in keys]
    plain_ = metrics.select(*keys, "metrica", "ordem", plain(F.col("valor")).alias("v"))
    rows = plain_.groupBy(*keys).agg(*[
        F.max_by(F.col("v"), F.when(F.col("metrica") == f.name, F.col("ordem"))).alias(f.name) for f in own])
    return rows.select(*keys, *[
        (text.number(F.col(f.name), f.dataType.simpleString()) if f.dataType.simpleString() in text.INTEGERS
         else F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in own])
