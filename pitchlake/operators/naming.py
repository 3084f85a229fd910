"""Standard names for competitions and clubs.

Dictionaries are lookup tables. The join type is left to Spark, which broadcasts
a dictionary when its measured size is under the threshold and shuffles otherwise.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions import fixed, text


def competition_names(spark: SparkSession) -> DataFrame:
    """The built-in competition dictionary (a fixed list of 156 names)."""
    return spark.createDataFrame(
        list(fixed.COMPETITION_NAMES.items()), "origem STRING, nome STRING"
    )


def standard_competition(
    df: DataFrame, column: str = "campeonato", names: DataFrame | None = None
) -> DataFrame:
    """Competition name up to the first comma, replaced when the dictionary knows it."""
    if names is None:
        lookup = F.broadcast(competition_names(df.sparkSession))
    else:
        lookup = names
    lookup = lookup.select(F.col("origem").alias("_origem"), F.col("nome").alias("_nome"))
    keyed = df.withColumn("_origem", text.competition_key(F.col(column)))
    return (
        keyed.join(lookup, "_origem", "left")
        .withColumn(column, F.coalesce("_nome", "_origem"))
        .drop("_nome", "_origem")
    )


def standard_club(
    df: DataFrame, names: DataFrame, id_column: str, name_column: str
) -> DataFrame:
    """Display name of the club id, else the trimmed source name; the id stays beside it."""
    lookup = names.select(F.col("club_id").alias(id_column), F.trim("nome").alias("_nome"))
    source: Column = F.trim(F.coalesce(F.col(name_column), F.lit("")))
    return (
        df.join(lookup, id_column, "left")
        .withColumn(name_column, F.coalesce(F.nullif(F.col("_nome"), F.lit("")), source))
        .drop("_nome")
    )


def club_names_from_entries(entries: DataFrame) -> DataFrame:
    """Club dictionary from (ordem, club_id, nome) entries: the last entry of an id wins."""
    return entries.groupBy("club_id").agg(F.max_by("nome", "ordem").alias("nome"))


#: Compares without regard to case and accents, as the servers' default collation does.
LENIENT = "UNICODE_CI_AI"


def _key(c: Column, collation: str) -> Column:
    return F.collate(F.trim(c), collation)


def ambiguous_names(names: DataFrame, collation: str = LENIENT) -> DataFrame:
    """Dictionary names that the collation takes for one but that mean different clubs.

    (nome, club_ids, nomes): one spelling, the clubs, and all spellings.
    """
    keyed = names.filter(F.col("nome").isNotNull()).select("club_id", F.trim("nome").alias("nome"), _key(F.col("nome"), collation).alias("_k"))
    return keyed.groupBy("_k").agg(
        F.min("nome").alias("nome"), F.array_sort(F.collect_set("club_id")).alias("club_ids"),
        F.array_sort(F.collect_set("nome")).alias("nomes")).filter(F.size("club_ids") > 1).drop("_k")


def club_by_name(
    df: DataFrame, names: DataFrame, column: str, collation: str = LENIENT
) -> DataFrame:
    """Club id and standard name of a source name, by the exact name first, then under the collation.

    Adds ``club_id``, ``nome`` and ``por``: 'exato', 'comparado', 'ambiguo' (several clubs under
    the collation and none exactly: no club is picked), or NULL for an unknown name. Rows are
    never multiplied: the dictionary is cut to one row for each key before the joins, and a
    name that most rows have only meets that row.
    """
    listed = names.filter(F.col("nome").isNotNull()).select("club_id", F.trim("nome").alias("_nome"))
    exact = listed.groupBy("_nome").agg(F.min("club_id").alias("_exact"), F.countDistinct("club_id").alias("_exact_n"))
    loose = listed.withColumn("_k", _key(F.col("_nome"), collation)).groupBy("_k").agg(
        F.min("club_id").alias("_loose"), F.min("_nome").alias("_loose_name"), F.countDistinct("club_id").alias("_loose_n"))
    # Names, not rows, meet the dictionary; then rows meet their name.
    seen = df.select(F.trim(F.col(column)).alias("_source")).filter("_source IS NOT NULL").distinct()
    found = seen.join(exact.withColumnRenamed("_nome", "_source"), "_source", "left")
    found = found.withColumn("_k", _key(F.col("_source"), collation)).join(loose, "_k", "left").drop("_k")
    one = F.col("_exact_n") == 1
    near = F.col("_exact_n").isNull() & (F.col("_loose_n") == 1)
    found = found.select(
        "_source",
        F.when(one, F.col("_exact")).when(near, F.col("_loose")).alias("club_id"),
        F.when(one, F.col("_source")).when(near, F.col("_loose_name")).alias("nome"),
        F.when(one, "exato").when(near, "comparado").when(F.col("_loose_n").isNotNull(), "ambiguo").alias("por"))
    return df.withColumn("_source", F.trim(F.col(column))).join(found, "_source", "left").drop("_source")
