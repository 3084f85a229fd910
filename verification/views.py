"""The match, team-stats, player-stats and goals contracts as views on the given tables.

An order is a match, its customer's nation the home club, a line item a player's
appearance. Column rules are written the same way in ``verification.oracle``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared schemas: no job is spent on reading footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _bigint(c: Column) -> Column:
    return c.cast("bigint")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    # nation and region have 25 and 5 rows at every scale
    home = F.broadcast(
        n.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("hk"), F.col("n_name").alias("casa"), "r_name")
    )
    away = F.broadcast(n.select(F.col("n_nationkey").alias("ak"), F.col("n_name").alias("fora")))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    cents = _bigint(F.round(F.col("o_totalprice") * 100))
    year = F.year("o_orderdate")
    played = ~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "2-HIGH"))
    priced = cust % 23 != 0

    def odd(base: int, mod: int) -> Column:
        return F.when(priced, ((F.lit(base) + cents % mod) / 100).cast("decimal(8,2)"))

    return (
        o.join(c, cust == F.col("c_custkey"))
        .withColumn("ak", ((F.col("c_nationkey") + 1 + (key * 7 + cust) % 24) % 25).cast("int"))
        .join(home, F.col("c_nationkey") == F.col("hk"))
        .join(away, "ak")
        .select(
            key.alias("id_jogo"),
            F.col("o_orderdate").cast("date").alias("data"),
            F.format_string("%02d:%02d", 12 + cust % 10, (key % 4) * 15).alias("hora"),
            F.when(F.col("o_orderpriority") == "5-LOW", "Mundo")
            .otherwise(F.col("r_name")).alias("pais"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Amistoso")
            .otherwise(F.col("o_orderpriority")).alias("campeonato"),
            (1 + key % 38).cast("string").alias("rodada"),
            "casa",
            "fora",
            F.when(played, (cents % 97 % 6).cast("int")).alias("gols_casa"),
            F.when(played, (cents % 89 % 5).cast("int")).alias("gols_fora"),
            F.when(
                F.col("r_name") == "EUROPE",
                F.concat(year.cast("string"), F.lit("/"), (year + 1).cast("string")),
            ).otherwise(year.cast("string")).alias("temporada"),
            odd(90, 4999).alias("odd_casa"),
            odd(250, 311).alias("odd_empate"),
            odd(90, 5501).alias("odd_fora"),
            F.col("o_orderdate").cast("timestamp").alias("cadastrado_em"),
            cents.alias("_cents"),
        )
    )


# metric -> (prime, range); additive over the two halves
COUNTERS = {
    "total_shots": (1009, 17), "shots_on_target": (1013, 9), "shots_off_target": (1019, 7),
    "blocked_shots": (1021, 6), "shots_inside_box": (1031, 11), "shots_outside_box": (1033, 8),
    "hit_woodwork": (1039, 3), "big_chances": (1049, 5), "big_chances_scored": (1051, 3),
    "big_chances_missed": (1061, 4), "corner_kicks": (1063, 8), "passes": (1069, 350),
    "accurate_passes": (1087, 290), "through_balls": (1091, 6),
    "final_third_entries": (1093, 50), "fouled_in_final_third": (1097, 5),
    "dispossessed": (1103, 9), "tackles": (1109, 14), "interceptions": (1117, 10),
    "recoveries": (1123, 30), "clearances": (1129, 22), "goalkeeper_saves": (1151, 6),
    "yellow_cards": (1153, 4),
}
FRACTIONS = {"crosses": (1163, 12), "long_balls": (1171, 30),
             "ground_duels": (1181, 40), "aerial_duels": (1187, 20)}


def team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(spark, sf_dir)
    side = F.explode(
        F.array(
            F.struct(F.col("casa").alias("clube"), F.lit(0).alias("lado")),
            F.struct(F.col("fora").alias("clube"), F.lit(1).alias("lado")),
        )
    ).alias("s")
    rows = (
        m.select("id_jogo", "temporada", "_cents", side)
        .select(
            "id_jogo", "temporada", F.col("s.clube").alias("clube"),
            (F.col("id_jogo") * 13 + F.col("_cents") + F.col("s.lado") * 101).alias("b"),
        )
        .select("*", F.explode(F.array(F.lit("1ST"), F.lit("2ND"), F.lit("ALL"))).alias("periodo"))
    )
    first, second = F.col("b") + 977, F.col("b") + 1954
    k = F.when(F.col("periodo") == "1ST", first).when(F.col("periodo") == "2ND", second).otherwise(
        F.col("b")
    )

    def counter(prime: int, size: int) -> Column:
        one, two = first % prime % size, second % prime % size
        return (
            F.when(F.col("periodo") == "1ST", one)
            .when(F.col("periodo") == "2ND", two)
            .otherwise(one + two)
            .cast("int")
        )

    def fraction(prime: int, size: int) -> Column:
        won, lost = k % prime % size, k % (prime + 2) % size
        share = F.floor(won * 100 / F.greatest(won + lost, F.lit(1)))
        return F.concat(
            won.cast("string"), F.lit("/"), (won + lost).cast("string"),
            F.lit(" ("), share.cast("string"), F.lit("%)"),
        )

    share = (30 + k % 41).cast("string")
    return rows.select(
        "id_jogo", "periodo", "clube", "temporada",
        F.when(k % 101 == 0, "n/d").when(k % 17 == 0, F.concat(share, F.lit(",5%")))
        .otherwise(F.concat(share, F.lit("%"))).alias("ball_possession"),
        F.concat((35 + k % 31).cast("string"), F.lit("%")).alias("duels"),
        F.concat((40 + k % 51).cast("string"), F.lit("%")).alias("tackles_won"),
        F.when(k % 19 != 0, (k % 1009 % 350) / 100).alias("expected_goals"),
        F.when(F.col("periodo") != "ALL", (k % 71 == 0).cast("int")).alias("red_cards"),
        *[fraction(*v).alias(name) for name, v in FRACTIONS.items()],
        *[counter(*v).alias(name) for name, v in COUNTERS.items()],
    )


def player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    m = matches(spark, sf_dir).select("id_jogo", "temporada", "casa", "fora")
    line, pk = F.col("l_linenumber"), F.col("l_partkey")
    j = F.col("l_orderkey") * 31 + pk * 17 + line * 7 + F.col("l_suppkey")
    slot = F.col("p_size") % 10
    return (
        li.join(part, pk == F.col("p_partkey"))
        .join(m, F.col("l_orderkey") == F.col("id_jogo"))
        .select(
            "id_jogo",
            F.when(line % 2 == 1, F.col("casa")).otherwise(F.col("fora")).alias("team"),
            pk.alias("player_id"),
            F.col("p_name").alias("name"),
            F.when(slot == 0, "G").when(slot <= 3, "D").when(slot <= 6, "M")
            .when(slot <= 8, "F").otherwise("X").alias("position"),
            (1 + pk % 99).cast("int").alias("jersey_number"),
            (160 + pk % 41).cast("int").alias("height"),
            (F.lit(-315619200) + pk % 9000 * 86400).cast("bigint").alias("date_of_birth_timestamp"),
            F.concat(F.lit("Country "), (F.col("p_size") % 7).cast("string")).alias("country"),
            (F.round(F.col("p_retailprice") * 100).cast("bigint") * 10)
            .cast("decimal(18,2)").alias("value"),
            (line > 4).alias("substitute"),
            (j % 11 == 0).alias("captain"),
            F.when(j % 23 != 0, (50 + j % 50) / 10).alias("rating"),
            F.greatest(F.lit(0), F.col("l_quantity").cast("int") * 2 - 6).alias("minutes_played"),
            F.when(j % 31 == 0, 2).when(j % 7 == 0, 1).otherwise(0).alias("goals"),
            (j % 5 == 0).cast("int").alias("goal_assist"),
            (j % 11 % 3).cast("int").alias("big_chance_created"),
            (j % 13 % 5).cast("int").alias("key_pass"),
            F.when(j % 9 != 0, j % 101 / 100).alias("expected_goals"),
            (j % 4).cast("int").alias("fouls"),
            (j % 29 == 0).cast("int").alias("penalty_conceded"),
            (j % 17 == 0).cast("int").alias("error_lead_to_a_shot"),
            (j % 37 == 0).cast("int").alias("error_lead_to_a_goal"),
            (j % 80).cast("int").alias("touches"),
            (j % 60).cast("int").alias("total_pass"),
            (j % 60 * 3 / 4).cast("int").alias("accurate_pass"),
            "temporada",
        )
    )


def goals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    minute = F.get_json_object("props", "$.k").cast("int") % 96
    foot = F.element_at(
        F.array(F.lit("right-foot"), F.lit("left-foot"), F.lit("head")),
        (F.col("event_id") % 3 + 1).cast("int"),
    )
    return e.select(
        F.col("user_id").alias("id_jogo"),
        F.lit("2024").alias("temporada"),
        F.lit("Copa").alias("campeonato"),
        F.col("event_type").alias("clube_gol"),
        minute.alias("minutos"),
        foot.alias("forma_gol"),
        F.concat_ws("-", (F.col("event_id") % 4).cast("string"),
                    (F.col("event_id") % 3).cast("string")).alias("placar"),
        F.col("event_id").alias("ordem"),
    )
