"""Documents are stored once for each match by keyed state, whatever the season says."""

import json
import pathlib

from pyspark.sql import Row
from pyspark.sql import types as T

from pitchlake.streaming import incremental, keyed


def doc(id_, season, shots, pad=""):
    body = {"statistics": [{"period": "ALL", "groups": [{"statisticsItems": [{"name": "Total shots", "home": shots, "away": "0"}]}]}], "pad": pad}
    return json.dumps({"id_jogo": id_, "casa": "H", "fora": "A", "temporada": season, "campeonato": "L", "doc": json.dumps(body)})


def land(folder, name, lines):
    pathlib.Path(folder).mkdir(exist_ok=True)
    (pathlib.Path(folder) / name).write_text("\n".join(lines) + "\n")


def stored(spark, log):
    rows = incremental.read_log(spark, str(log), incremental.STATISTICS).filter("clube = 'H'")
    return sorted((r.id_jogo, r.temporada, r.metricas["total_shots"]) for r in rows.collect())


def test_redelivery_under_another_season_gives_no_second_row(spark, tmp_path):
    landing, log, state = tmp_path / "landing", tmp_path / "log", tmp_path / "state"
    load = lambda where, to=log: incremental.load_statistics(spark, str(landing), str(to), str(where)).awaitTermination()
    land(landing, "a.json", [doc(1, "2025", "3"), doc(1, "2025/2026", "4", "longer"), doc(2, None, "5"), "{broken", json.dumps({"id_jogo": 4})])
    load(state)
    first = [(1, "2025/2026", "4"), (2, None, "5")]
    assert stored(spark, log) == first
    land(landing, "b.json", [doc(1, "2025", "7", "much longer"), doc(2, "2025", "8"), doc(3, "2025", "9")])
    load(state)
    assert stored(spark, log) == sorted([*first, (3, "2025", "9")], key=str)
    # A new checkpoint starts with the log's ids.
    load(tmp_path / "other")
    assert stored(spark, log) == sorted([*first, (3, "2025", "9")], key=str)
    # The ids come from state: into an empty log the old checkpoint writes nothing known again.
    land(landing, "c.json", [doc(1, "2026", "1"), doc(5, "2025", "6")])
    load(state, tmp_path / "empty")
    assert stored(spark, tmp_path / "empty") == [(5, "2025", "6")]
    rejected = spark.read.parquet(incremental.rejected_dir(str(log)))
    assert {r.linha for r in rejected.collect()} == {"{broken", '{"id_jogo":4}'}


def test_batches_do_not_scan_the_log(spark, tmp_path, monkeypatch):
    plans = []

    def seen(df, *rest):
        df.write.format("noop").mode("overwrite").save()
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(incremental, "store_first", seen)
    land(tmp_path / "landing", "a.json", [doc(1, "2025", "3")])
    for name in ("a.json", "b.json"):
        land(tmp_path / "landing", name, [doc(1, "2025", "3"), doc(2, "2025", "3")])
        incremental.load_statistics(spark, str(tmp_path / "landing"), str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    assert len(plans) == 2 and "parquet" not in plans[1].lower()


def test_overlapping_loaders_are_settled_when_read(spark):
    log = spark.createDataFrame([(1, 0, "a", 10), (1, 0, "a", 11), (1, 1, "b", 12), (2, 1, "b", 13)], "id_jogo long, ordem long, carga string, v int")
    assert sorted(r.v for r in keyed.first_rows(log, "id_jogo", ["ordem", "carga"]).collect()) == [10, 11, 13]




def test_a_shard_of_ids_costs_one_read_and_one_write_of_state():
    calls = []

    class State:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

    class Handle:
        def getValueState(self, name, schema):
            return State()

    first = keyed.FirstDelivery("id", T.LongType(), "doc")
    first.init(Handle())
    row = Row("id", "doc", "s")
    rows = [row(i, d, s) for i in range(100) for d, s in (("a", "x"), ("bb", "x"), ("bb", "y"), ("a", "z"))]
    assert list(first.handleInputRows((0,), iter(rows), None)) == [row(i, "bb", "y") for i in range(100)]
    assert calls == ["get", "update"]
    first.handleInitialState((0,), Row(ids=[100, 101]), None)
    del calls[:]
    assert [r.id for r in first.handleInputRows((0,), iter([row(i, "longer", "x") for i in range(103)]), None)] == [102]
    assert calls == ["get", "update"] and not list(first.handleInputRows((0,), iter(rows), None)) and calls[2:] == ["get"]


def line(id_, home, season, text):
    return json.dumps({"id_jogo": id_, "casa": home, "fora": "A", "temporada": season, "campeonato": "L", "doc": text})


def test_lines_are_read_again_as_keyed_state_chooses_them(spark, tmp_path, monkeypatch):
    """Files with odd names, equal copies, documents of one length, one document under several contexts."""
    got, landing = [], tmp_path / "land ing"
    monkeypatch.setattr(incremental, "store_first", lambda df, *rest: got.extend(df.collect()))
    contexts = [("H", "2025"), ("H", None), ("H B", "2025"), ("H", "2024")]
    lines = [line(i % 9, *contexts[(i // 9) % 4], "xy"[i % 2] * (1 + i % (2 + i % 9 // 3))) for i in range(120)] + [line(50, "H", "2025", "only")]
    for k, name in enumerate(("a b%20.json", "\u00e9{1}[x].json", "c.json")):
        land(landing, name, lines[k::3] + ["{broken", lines[k]])
    load = lambda: incremental.load_statistics(spark, str(landing), str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    load()
    first, best = keyed.FirstDelivery("id_jogo", T.LongType(), "doc"), {}
    for text in lines:
        r = Row(**json.loads(text))
        if r.id_jogo not in best or first._before(r, best[r.id_jogo]):
            best[r.id_jogo] = r
    assert sorted(map(repr, got)) == sorted(map(repr, best.values())) and len(got) == 10
    del got[:]
    load()
    assert got == []
    land(landing, "d.json", [line(3, "H", "2025", "a much longer text"), line(51, "H", "2025", "new")])
    load()
    assert [(r.id_jogo, r.doc) for r in got] == [(51, "new")]


def test_documents_are_shuffled_once_when_new_and_never_when_known(spark, tmp_path, monkeypatch):
    steps = []

    def seen(df, *rest):
        df.write.format("noop").mode("overwrite").save()
        steps.append(df._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0].split("\n"))

    monkeypatch.setattr(incremental, "store_first", seen)
    for name in ("a.json", "b.json"):
        land(tmp_path / "landing", name, [doc(i, "2025", "3") for i in range(20)])
        incremental.load_statistics(spark, str(tmp_path / "landing"), str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    new, known = ["\n".join(s) for s in steps]
    assert "ShuffledHashJoin" in new and "Sort" not in new and new.count("FileScan json") == 1
    assert "FileScan json" not in known


def test_a_place_is_one_row_for_each_new_id():
    class Handle:
        def getValueState(self, name, schema):
            return self

        def get(self):
            return ([7],)

        def update(self, value):
            self.value = value

    first, handle, row = keyed.FirstPlaces("id", T.LongType(), keyed.LENGTH), Handle(), Row("id", keyed.LENGTH, keyed.FILES)
    first.init(handle)
    data = [row(1, 5, 10), row(7, 9, 10), row(1, 6, 11), row(1, 6, 12), row(1, 6, 11), row(2, 0, 10), row(1, 5, 13)]
    assert [tuple(r) for r in first.handleInputRows((0,), iter(data), None)] == [(1, 6, 3, [11, 12]), (2, 0, 1, [10])]
    assert handle.value == ([7, 1, 2],)


def test_queries_land_compressed_files_of_some_lines(spark, monkeypatch):
    from verification import queries_ingest as queries

    monkeypatch.setattr(queries, "LANDED_LINES", 4)
    counts, names = [], set()

    def load(spark, landing, log, state):
        counts.append(spark.read.json(landing).count())
        names.update(p.name for p in pathlib.Path(landing.removeprefix("file:")).glob("part-*"))
        incremental.create_log(spark, log, incremental.STATISTICS)
        return type("Load", (), {"awaitTermination": lambda self: None})()

    lines = spark.range(10).selectExpr("id AS id_jogo", "'x' AS doc").coalesce(1)
    queries._twice(spark, load, lines, incremental.STATISTICS)
    assert counts == [10, 20, 30] and len(names) == 9 and all(n.endswith(".json.gz") for n in names)


def test_goals_of_many_seasons_are_written_side_by_side(spark, tmp_path, monkeypatch):
    """Without a sort up to some seasons, all of them beyond; only the stream's own session is set so."""
    setting, held, store = "spark.sql.maxConcurrentOutputFileWriters", [], incremental.store_first
    before = spark.conf.get(setting, None)

    def seen(df, *rest):
        held.append(df.sparkSession.conf.get(setting))
        store(df, *rest)

    monkeypatch.setattr(incremental, "store_first", seen)
    goal = json.dumps({"incidents": [{"incidentType": "goal", "time": 5, "isHome": True}]})
    seasons = [str(2000 + i) for i in range(incremental.SEASONS_OPEN + 4)]
    land(tmp_path / "landing", "a.json", [line(i, "H", seasons[i % len(seasons)], goal) for i in range(60)])
    incremental.load_goals(spark, str(tmp_path / "landing"), str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    rows = incremental.read_log(spark, str(tmp_path / "log"), incremental.schemas.GOALS).collect()
    assert sorted((r.id_jogo, r.temporada, r.minutos) for r in rows) == [(i, seasons[i % len(seasons)], 5) for i in range(60)]
    assert held == [str(incremental.SEASONS_OPEN)] and spark.conf.get(setting, None) == before
