from builders import match, rows
from pitchlake import schemas
from pitchlake.sources import tables

STATS = "id_jogo long, temporada string, clube string, periodo string"


def made(spark):
    m = spark.createDataFrame([
        match(1, "2025-01-05", "A", "B", 1, 0), match(2, "2025-01-06", "A", "C", 1, 0, temporada="2025/2026"),
        match(3, "2025-01-07", "B", "C", 1, 0, temporada=None), match(3, "2025-01-07", "B", "C", 1, 0, temporada=None, campeonato=None),
    ], schemas.MATCHES)
    s = spark.createDataFrame([
        (1, "2025", "A", "ALL"), (1, None, "B", "ALL"), (2, "2025", "A", "ALL"), (3, None, "B", "ALL"), (3, "2025", "C", "ALL"),
        (9, "2025", "A", "ALL"), (None, "2025", "A", "ALL"), (None, None, "A", "ALL")], STATS)
    return s, m


def test_every_row_is_accounted_for(spark):
    s, m = made(spark)
    got = tables.accounted(s, m).collect()
    want = {(1, "A"): "ok", (1, "B"): "sem temporada", (2, "A"): "temporada difere", (3, "B"): "ok", (3, "C"): "temporada difere",
            (9, "A"): "sem jogo", (None, "A"): "sem id"}
    assert len(got) == 8 and all(want[r.id_jogo, r.clube] == r.situacao for r in got)
    assert {r.temporada_jogo for r in got if r.id_jogo == 2} == {"2025/2026"}
    assert [r.campeonato for r in got if r.id_jogo == 3] == ["Liga", "Liga"]  # the fullest copy, once
    audit = rows(tables.join_audit(s, m), "situacao", "temporada", "temporada_jogo")
    assert sum(r.linhas for r in audit.values()) == 8 and audit["sem id", "2025", None].jogos == 0


def test_statistics_of_any_season_reach_the_tables(spark):
    s, m = made(spark)
    m = m.filter("id_jogo < 3")
    got = rows(tables.team_stats_of(s, m), "id_jogo", "clube")
    assert {k: r.temporada for k, r in got.items()} == {(1, "A"): "2025", (1, "B"): "2025", (2, "A"): "2025/2026"}
    hinted = rows(tables.team_stats_of(s, m, seasons=["2025/2026"]), "id_jogo", "clube")
    assert set(hinted) == {(1, "B")}  # a hint keeps rows without a season
    agreed = tables.with_match_season(s, m)
    assert {(r.id_jogo, r.temporada) for r in agreed.collect()} == {
        (1, "2025"), (2, "2025/2026"), (3, None), (3, "2025"), (9, "2025"), (None, "2025"), (None, None)}
    assert tables.team_stats_of(agreed, m, seasons=["2025/2026"]).count() == 1


def test_no_rows(spark):
    s, m = made(spark)
    assert tables.accounted(s.limit(0), m).count() == 0
    assert {r.situacao for r in tables.accounted(s, m.limit(0)).collect()} == {"sem jogo", "sem id"}


def test_wide_rows_are_hashed_and_not_sorted_for_a_join(spark, matches):
    """Where one side is small in every partition, as at run time here, no side is sorted."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(200).selectExpr("id % 10 + 1 AS id_jogo", "'A' AS clube", "'2025' AS temporada", "'ALL' AS periodo", "id AS v").repartition(3)
        for df in (tables.team_stats_both_sides(rows, matches, ["A"]), tables.team_stats_of(rows, matches)):
            assert df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert "ShuffledHashJoin" in plan and "Sort " not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
