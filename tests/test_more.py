import itertools

from builders import match, rows
from pitchlake import schemas
from pitchlake.operators import naming, sinks
from pitchlake.operators import players as pl
from pitchlake.sources import tables

GOALS = "id_jogo long, clube_gol string, minutos int"


def test_leader_lists_take_one_expand_and_one_shuffle_of_totals(spark):
    data = [(1, "P", "Atacante", 90, 2), (1, "P", "Defensor", 10, 1), (2, "Q", "Atacante", 50, 2), (2, "Q", None, 5, 9), (3, None, "Atacante", 1, 9),
            (4, "R", "Goleiro", 95, 0)]
    df = spark.createDataFrame(data, "player_id long, name string, position string, minutes_played int, goals int")
    lists = pl.leader_lists(df, ["minutes_played", "goals"], 2)
    got = {(r.metrica, r.lista, r.posicao): (r.name, r.valor) for r in lists.collect()}
    assert got["minutes_played", "Geral", 1] == ("P", 100) and got["minutes_played", "Geral", 2] == ("R", 95)
    assert got["goals", "Geral", 1] == ("P", 3) and got["goals", "Atacante", 2] == ("Q", 2)
    assert ("goals", "Goleiro", 1) not in got and len(got) == 11
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange hashpartitioning") == 2  # totals, and the lists they are cut to


def brute_states(goals, games, whistle=90):
    out = {}
    for i, casa, fora in games:
        own = [(m, c) for g, c, m in goals if g == i and m is not None and m >= 0 and c in (casa, fora)]
        end = max([whistle, *[m + 1 for m, _ in own]])
        for minute in range(end):
            d = sum(1 if c == casa else -1 for m, c in own if m <= minute)
            for club, s in ((casa, d), (fora, -d)):
                state = "vencendo" if s > 0 else "perdendo" if s < 0 else "empatando"
                out[club, state] = out.get((club, state), 0) + 1
    return out


def test_minutes_by_state_equal_a_walk_over_every_minute(spark):
    games = [(1, "A", "B"), (2, "B", "C"), (3, "C", "A")]
    goals = [(1, "A", 10), (1, "B", 10), (1, "A", 30), (1, "A", 95), (1, "Z", 50), (1, "B", None), (1, "B", -1), (2, "C", 0), (2, "B", 89), (9, "A", 5)]
    m = spark.createDataFrame([match(i, "2025-01-01", a, b, 0, 0) for i, a, b in games], schemas.MATCHES)
    timeline = pl.score_timeline(spark.createDataFrame(goals, GOALS), m)
    spans = sorted((r.id_jogo, r.inicio, r.fim, r.gols_casa, r.gols_fora) for r in timeline.collect())
    assert [s for s in spans if s[0] == 1] == [(1, 0, 10, 0, 0), (1, 10, 30, 1, 1), (1, 30, 95, 2, 1), (1, 95, 96, 3, 1)]
    assert [s for s in spans if s[0] == 3] == [(3, 0, 90, 0, 0)]
    got = rows(pl.minutes_by_state(timeline), "clube")
    want = brute_states(goals, games)
    for club, state in itertools.product("ABC", pl.STATES):
        assert got[club][state] == want.get((club, state), 0)
    at = pl.at_score(spark.createDataFrame(goals, GOALS), timeline, "minutos", "clube_gol").filter("id_jogo = 1 AND minutos = 30").first()
    assert (at.gols_casa, at.estado) == (2, "vencendo")


def test_names_under_a_collation(spark):
    names = spark.createDataFrame([(1, "São Paulo"), (2, "Grêmio"), (3, "GREMIO"), (4, None), (5, "Inter"), (6, " Inter ")], "club_id long, nome string")
    df = spark.createDataFrame([(i, n) for i, n in enumerate(["sao paulo", "São Paulo", "gremio", "Grêmio ", "Inter", "x", None, "SÃO PAULO"])], "i int, clube string")
    got = rows(naming.club_by_name(df, names, "clube"), "i")
    assert [(got[i].club_id, got[i].nome, got[i].por) for i in range(8)] == [
        (1, "São Paulo", "comparado"), (1, "São Paulo", "exato"), (None, None, "ambiguo"), (2, "Grêmio", "exato"), (None, None, "ambiguo"),
        (None, None, None), (None, None, None), (1, "São Paulo", "comparado")]
    assert {tuple(r.club_ids) for r in naming.ambiguous_names(names).collect()} == {(2, 3), (5, 6)}


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    m = spark.createDataFrame([match(i, "2025-01-01", "A", "B", 1, 0) for i in range(40)], schemas.MATCHES)
    s = spark.createDataFrame([(i, "ALL", c, "2025") for i in range(40) for c in "AB"], "id_jogo long, periodo string, clube string, temporada string")
    stored = [sinks.store_bucketed(df, f"b_{n}_{tmp_path.name}".replace("-", "_"), str(tmp_path / n), 4) for n, df in (("m", m), ("s", s))]
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables.team_stats_of(stored[1], stored[0])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 80
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_buckets_grow_with_the_largest_table(spark, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKET_ROWS", 10)
    assert sinks.buckets_for(spark.range(5), spark.range(95), least=4) == 16
    assert sinks.buckets_for(spark.range(5), spark.range(0), least=4) == 4


def test_files_of_a_layout_are_written_by_many_tasks_each_with_its_header(spark, matches, monkeypatch):
    from verification import queries_more

    seen = []
    read = queries_more.mixed.read_mixed_history
    monkeypatch.setattr(queries_more.mixed, "read_mixed_history", lambda s, path: seen.append(path) or read(s, path))
    monkeypatch.setattr(queries_more.views, "matches", lambda s, sf: matches.repartition(5))
    got = queries_more.s20(spark, "").collect()
    assert sorted(r.layout for r in got) == sorted(r.id_jogo % 3 for r in matches.collect()) and not any(r.motivo for r in got)
    lines = spark.read.text(seen[0]).selectExpr("_metadata.file_path AS f", "value AS v").collect()
    for i, header in ((0, "Data,Torneio,"), (1, "Season;Home;")):
        files = {r.f for r in lines if f"/{i}/part" in r.f}
        assert len(files) > 1
        for f in files:
            assert [r.v for r in lines if r.f == f][0].startswith(header)


def test_most_minutes_are_broadcast_beside_many_players(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")
    try:
        players = spark.range(5000).selectExpr(
            "id AS player_id", "'P' || id AS name", "'Atacante' AS position", "'T' AS team", "'C' || (id % 3) AS campeonato",
            "CAST(id % 90 + 1 AS INT) AS minutes_played", "CAST(7.5 AS DOUBLE) AS rating")
        df = pl.regulars(players, "rating")
        assert "BroadcastHashJoin" in df._jdf.queryExecution().sparkPlan().toString()
        assert df.count() == sum((i % 90 + 1) * 100 >= max(j % 90 + 1 for j in range(i % 3, 90, 3)) * 40 for i in range(5000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
