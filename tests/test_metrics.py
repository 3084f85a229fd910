import json

import pytest

from builders import rows
from pitchlake import schemas
from pitchlake.sources import metrics

DOCS = "id_jogo long, casa string, fora string, temporada string, doc string"
KEYS = ["id_jogo", "temporada", "periodo", "clube"]


def item(name, home, away):
    return {"name": name, "home": home, "away": away}


def bronze(spark, *docs):
    return metrics.bronze(spark.createDataFrame([(i, "H", "A", "2025", d) for i, d in enumerate(docs)], DOCS))


def stats(*items, period="ALL"):
    return json.dumps({"statistics": [{"period": period, "groups": [{"statisticsItems": list(items)}, {}]}]})


def test_a_new_label_is_kept_reported_and_widened(spark):
    b = bronze(spark, stats(item("Total shots", "3", "4"), item("VAR checks", 1, None)),
               stats(item("Total shots", "5", "x"), item("Pressing (index)", "0.5", 2), item("Note", "n/a", "")),
               "no json", None, "{}", '{"statistics": 7}', '{"statistics": [null, {"period": "ALL"}]}')
    assert [r.linha for r in b.filter("linha IS NOT NULL").collect()] == ["no json"]
    long = metrics.team_metrics(b)
    found = rows(metrics.catalogue(long), "metrica")
    assert {m: (r.rotulos, r.linhas, r.preenchidas, r.tipo) for m, r in found.items()} == {
        "total_shots": (["Total shots"], 4, 4, "string"), "var_checks": (["VAR checks"], 2, 1, "int"),
        "pressing_index": (["Pressing (index)"], 2, 2, "double"), "note": (["Note"], 2, 1, "string")}
    beside = rows(metrics.against(metrics.catalogue(long), schemas.TEAM_STATS, KEYS), "metrica")
    assert beside["var_checks"].situacao == "nova" and beside["passes"].situacao == "ausente"
    assert (beside["total_shots"].situacao, beside["total_shots"].cabe) == ("declarada", False)
    wider = metrics.widened(schemas.TEAM_STATS, metrics.catalogue(long), ["var_checks"])
    assert wider.fieldNames()[-1] == "var_checks" and len(wider) == len(schemas.TEAM_STATS) + 1
    got = rows(metrics.wide(long, wider, KEYS), "id_jogo", "clube")
    assert (got[0, "H"].total_shots, got[0, "H"].var_checks, got[0, "A"].var_checks) == (3, 1, None)
    assert (got[1, "A"].total_shots, got[1, "A"].var_checks) == (None, None)
    every = metrics.widened(schemas.TEAM_STATS, metrics.catalogue(long))
    assert every.fieldNames()[-3:] == ["note", "pressing_index", "var_checks"]
    with pytest.raises(ValueError, match="no such"):
        metrics.widened(schemas.TEAM_STATS, metrics.catalogue(long), ["nothing"])


def test_the_last_value_of_a_metric_stays_and_a_period_counts_once(spark):
    twice = json.dumps({"statistics": [
        {"period": "ALL", "groups": [{"statisticsItems": [item("Total shots", 1, 1)]}, {"statisticsItems": [item("total (shots)", 2, 2)]}]},
        {"period": "ALL", "groups": [{"statisticsItems": [item("Total shots", 9, 9)]}]}]})
    got = rows(metrics.wide(metrics.team_metrics(bronze(spark, twice)), schemas.TEAM_STATS, KEYS), "clube")
    assert got["H"].total_shots == 2


def test_player_metrics(spark):
    player = {"player": {"id": 7, "name": "P"}, "statistics": {"keyPass": 3, "newThing": "a", "nested": {"x": 1}, "ratingVersions": {"original": 7}}}
    b = bronze(spark, json.dumps({"home": {"players": [player, {"player": {"id": 8}}]}, "away": {}}), "{}")
    got = metrics.player_metrics(b)
    assert {(r.player_id, r.team, r.metrica) for r in got.collect()} == {(7, "H", "key_pass"), (7, "H", "new_thing"), (7, "H", "nested")}
    kinds = rows(metrics.catalogue(got), "metrica")
    assert [kinds[m].tipo for m in ("key_pass", "new_thing", "nested")] == ["int", "string", "string"]


def test_no_documents(spark):
    empty = metrics.team_metrics(metrics.bronze(spark.createDataFrame([], DOCS)))
    assert metrics.catalogue(empty).count() == 0
    assert metrics.widened(schemas.TEAM_STATS, metrics.catalogue(empty)) == schemas.TEAM_STATS


def test_values_are_counted_before_they_are_read_as_numbers(spark):
    home = [{"player": {"id": i}, "statistics": {"a": 2, "b": v, "c": None}} for i, v in enumerate(["1.0", 1, 1, "", " ", {"x": 1}, 1.5])]
    odd = [{"player": {"id": 9}, "statistics": [1, 2]}, {"player": {"id": 9}, "statistics": 3}, 7, None]
    huge = '{"home": {"players": {"0": 1}}, "away": {"players": [{"statistics": {"d": 1e999, "e": 5000000000}}]}}'
    found = metrics.catalogue(metrics.player_metrics(bronze(spark, json.dumps({"home": {"players": home + odd}}), huge)))
    assert {r.metrica: (r.rotulos, r.linhas, r.preenchidas, r.tipo) for r in found.collect()} == {
        "a": (["a"], 7, 7, "int"), "b": (["b"], 7, 5, "string"), "c": (["c"], 7, 0, None),
        "d": (["d"], 1, 1, "double"), "e": (["e"], 1, 1, "bigint")}
    below = found._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[-1].split("\n", 1)[1]  # the rows of each value
    assert "as double" not in below and "map_entries" not in below
