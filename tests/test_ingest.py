import datetime
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from builders import MATCHES, match, rows
from pitchlake import schemas
from pitchlake.operators import naming, sinks
from pitchlake.sources import documents, files
from pitchlake.streaming import incremental

LOADED = "2024-01-01 00:00:00"


def when():
    return F.lit(LOADED).cast("timestamp")


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


# --- CSV ---------------------------------------------------------------------------
def test_match_backup(spark, tmp_path):
    head = ("id;temporada;id_jogo;data;hora;campeonato;pais;rodada;casa;fora;gols_casa;gols_fora;"
            "odd_casa;odd_empate;odd_fora;cadastrado_em;sobra\n")
    body = ("1;2025;10;2025-03-01;16:00;Liga;nan;1;A;B;2;NaN;1.50;;3.00;02/03/2025 10:30;x\n"
            "2;2020/2021;11;01/03/2025;16:00;Liga;Brasil;1;A;B;1;1;1.50;2.00;3.00;bad;x\n")
    path = write(tmp_path / "b.csv", head + body)
    got = rows(files.read_matches_csv(spark, path, when()), "id_jogo")
    assert got[10].pais is None and got[10].gols_fora is None and got[10].odd_empate is None
    assert got[10].cadastrado_em == datetime.datetime(2025, 3, 2, 10, 30)
    assert got[11].data == datetime.date(2025, 3, 1) and got[11].temporada == "2020/2021"
    assert got[11].cadastrado_em == datetime.datetime(2024, 1, 1)


def test_match_backup_without_a_column(spark, tmp_path):
    with pytest.raises(ValueError, match="missing columns"):
        files.read_matches_csv(spark, write(tmp_path / "b.csv", "id;casa\n1;A\n"))


@pytest.mark.parametrize("sep", [";", ",", "\t", "|"])
def test_goal_file_separator_comes_from_the_header(spark, tmp_path, sep):
    head = ["id_jogo", "temporada", "campeonato", "clube_gol", "minutos", "forma_gol", "placar"]
    line = ["7", "2025", "Liga", "Ação", "45", "head", "1-0"]
    path = write(tmp_path / "g.csv", sep.join(head) + "\n" + sep.join(line) + "\n", "latin-1")
    r = files.read_goals_csv(spark, path, encoding="ISO-8859-1", loaded_at=when()).first()
    assert (r.id_jogo, r.clube_gol, r.minutos, r.placar) == (7, "Ação", 45, "1-0")


def test_history_header_wordings():
    got = files.match_history_header(
        ["date", "torneio", "ano", "home", "placar_casa", "gols_away", "time_visitante"])
    assert list(got.values()) == ["data", "campeonato", "temporada", "casa", "gols_casa",
                                  "gols_fora", "fora"]
    assert files.match_history_header(["data_do_jogo", "x"]) == {"data_do_jogo": "data"}


def test_history_lines(spark, tmp_path):
    text = ("﻿Data;Competição;Temporada;Mandante;Gols Mandante;Gols Visitante;Visitante\n"
            "2020-01-01;" + "L" * 120 + ";2020;A;1;x;B\n"
            "2020-01-02;Liga;2020;A;1;2;B;extra\n"
            "2020-01-03;Liga;2020;A\n"
            "bad;Liga;2020;A;1;2;B\n")
    got = rows(files.read_history_csv(spark, write(tmp_path / "h.csv", text)), "data")
    assert sorted(d.day for d in got) == [1, 3]
    first, short = got[datetime.date(2020, 1, 1)], got[datetime.date(2020, 1, 3)]
    assert len(first.campeonato) == 120 and first.gols_fora == 0
    assert short.fora is None and short.gols_casa == 0
    path = str(tmp_path / "h.csv")
    cut = files.read_history_csv(spark, path, widths={"campeonato": 100}).filter("day(data) = 1").first()
    assert len(cut.campeonato) == 100
    assert [(r.motivo, r.linha[:10]) for r in files.history_rejects(spark, path).collect()] == [
        ("campos", "2020-01-02"), ("data", "bad,Liga,2")]


def test_lenient_history_dates_and_float_goals(spark, tmp_path):
    text = ("Data;Campeonato;Temporada;Casa;Gols Casa;Gols Fora;Fora\n"
            "2025/01/05;L;2025;A;2.0;1.0;B\n5/1/2025;L;2025;A;2;1.0;B\n5-1-2025;L;2025;A;2;1;B\n")
    got = files.read_history_csv(spark, write(tmp_path / "h.csv", text)).collect()
    assert {(r.data, r.gols_casa, r.gols_fora) for r in got} == {(datetime.date(2025, 1, 5), 2, 1)} and len(got) == 3


def test_numbers_written_as_decimals(spark, tmp_path):
    head = "id_jogo;temporada;campeonato;clube_gol;minutos;forma_gol;placar\n"
    r = files.read_goals_csv(spark, write(tmp_path / "g.csv", head + "7.0;2025;L;A;45.0;head;1-0\n")).first()
    assert (r.id_jogo, r.minutos) == (7, 45)


def test_every_file_needs_the_same_header(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write(folder / "a.csv", "id_jogo;temporada;campeonato;clube_gol;minutos;forma_gol;placar\n1;2025;L;A;4;h;1-0\n")
    assert files.read_goals_csv(spark, str(folder)).count() == 1
    write(folder / "b.csv", "temporada;id_jogo;campeonato;clube_gol;minutos;forma_gol;placar\n2025;9;L;A;4;h;1-0\n")
    with pytest.raises(Exception, match="header"):
        files.read_goals_csv(spark, str(folder)).collect()


def test_header_in_the_files_encoding(spark, tmp_path):
    text = "Data;Competição;Temporada;Mandante;Gols Mandante;Gols Visitante;Visitante\n2020-01-01;Ação;2020;A;1;2;B\n"
    got = files.read_history_csv(spark, write(tmp_path / "h.csv", text, "latin-1"), encoding="ISO-8859-1").first()
    assert got.campeonato == "Ação"


def test_surplus_fields_fail_where_no_line_may_be_lost(spark, tmp_path):
    text = "Mandante,Visitante,Gol_Mandante,Gol_Visitante,Odd_1,Odd_X,Odd_2\nA,B,1.0,-,2,2,2\nA,B,1,1,2,2,2,9\n"
    with pytest.raises(Exception, match="surplus"):
        files.read_odds_csv(spark, write(tmp_path / "o.csv", text)).collect()


def test_history_without_header_and_with_missing_column(spark, tmp_path):
    plain = write(tmp_path / "p.csv", "2020-01-01,Liga,2020,Casa Pia,1,2,B\n")
    assert files.read_history_csv(spark, plain).first().casa == "Casa Pia"
    with pytest.raises(ValueError):
        files.read_history_csv(spark, write(tmp_path / "m.csv", "data,casa\n2020-01-01,A\n"))


def test_odds_file(spark, tmp_path):
    text = ("﻿Mandante,Visitante,Gol_Mandante,Gol_Visitante,Odd_1,Odd_X,Odd_2\n"
            "Vila Nova,Atletico,-,-,2.45,2.90,-\n")
    r = files.read_odds_csv(spark, write(tmp_path / "o.csv", text)).first()
    assert (r.casa, r.gols_casa, r.odd_casa, r.odd_fora) == ("Vila Nova", None, Decimal("2.45"), None)


def test_links(spark, tmp_path):
    text = "# Rodada 1\n'https://a.b/x#id:12',\n\"http://a.b/y\",\nhttps:///nohost\nfile:///x\n\n"
    got = [(r.link, r.id_jogo) for r in files.read_links(spark, write(tmp_path / "l.txt", text))
           .orderBy("posicao").collect()]
    assert got == [("https://a.b/x#id:12", 12), ("http://a.b/y", None)]


def test_link_filter_keeps_the_first_of_equal_links(spark):
    df = spark.createDataFrame(
        [(1, "https://a.b/1", "ok"), (2, "https://a.b/1", "ok"), (3, "chrome://x", "ok"),
         (4, "https://a.b/2", "Cancelado"), (5, "https://c.d/3", "ok"), (6, "https://a.b/skip/4", None)],
        "posicao long, link string, rotulo string")
    got = files.filter_links(df, "A.B", ["https://a.b/skip"], label="rotulo").collect()
    assert [(r.link, r.posicao) for r in got] == [("https://a.b/1", 1)]


# --- documents ----------------------------------------------------------------------
def doc_frame(spark, *docs):
    return spark.createDataFrame(
        [(i, "H", "V", "2025", "Liga", json.dumps(d)) for i, d in enumerate(docs)],
        "id_jogo long, casa string, fora string, temporada string, campeonato string, doc string")


def test_event_documents(spark):
    event = {"id": 5, "startTimestamp": 1741570200, "tournament": {"name": "LaLiga, Jornada 1"},
             "roundInfo": {"round": 7}, "homeTeam": {"id": 1, "name": " Alpha "},
             "awayTeam": {"id": 2, "name": "Beta"}, "homeScore": {"current": 2, "normaltime": 1},
             "awayScore": {}}
    entries = spark.createDataFrame(
        [(1, 1, "Old"), (2, 1, "New"), (3, 9, "Other")], "ordem int, club_id long, nome string")
    r = documents.flatten_events(
        spark.createDataFrame([(json.dumps(event),)], "doc string"),
        naming.club_names_from_entries(entries)).first()
    assert (r.data, r.hora) == (datetime.date(2025, 3, 9), "22:30")
    assert (r.campeonato, r.rodada, r.casa, r.fora) == ("La Liga", "7", "New", "Beta")
    assert (r.gols_casa, r.gols_fora, r.casa_id) == (1, 0, 1)


def test_statistics_documents(spark):
    def item(name, home, away):
        return {"name": name, "home": home, "away": away}

    good = {"statistics": [
        {"period": "ALL", "groups": [
            {"statisticsItems": [item("Big chances", 1, 2), item("Ball possession", "60%", "40%")]},
            {"statisticsItems": [item("Big chances", 3, 4)]}, {}]},
        {"period": "ALL", "groups": [{"statisticsItems": [item("Big chances", 9, 9)]}]},
        {"period": "1ST", "groups": []}, {"period": "2ND"}]}
    df = documents.flatten_team_stats(doc_frame(spark, good, {}, {"statistics": None}))
    got = rows(documents.widen(df, schemas.TEAM_STATS), "periodo", "clube")
    assert set(got) == {("ALL", "H"), ("ALL", "V")}
    assert (got[("ALL", "H")].big_chances, got[("ALL", "V")].big_chances) == (3, 4)
    assert got[("ALL", "H")].ball_possession == "60%" and got[("ALL", "H")].passes is None


def test_lineup_documents(spark):
    def p(id_, **stats):
        return {"player": {"id": id_, "name": "N", "position": "G", "jerseyNumber": "x"},
                "substitute": False, "statistics": stats}

    doc = {"home": {"players": [p(1, minutesPlayed=90, bigChanceCreated=2, keyPass=1.0,
                                  ratingVersions={"original": 7.1, "alternative": 6.0})]},
           "away": {"players": [p(2), {"player": {"id": 3}}]}}
    rows_ = documents.flatten_lineups(doc_frame(spark, doc, {"home": {}}))
    got = rows(documents.widen(rows_, schemas.PLAYER_STATS), "player_id")
    assert set(got) == {1, 2, 3} and got[1].key_pass == 1
    r = got[1]
    assert (r.team, r.minutes_played, r.big_chance_created, r.rating) == ("H", 90, 2, 7.1)
    assert r.jersey_number is None and got[2].team == "V" and got[3].rating is None


def test_lineup_with_one_metric_under_two_names(spark):
    text = ('{"home": {"players": [{"player": {"id": 1}, "statistics": {"keyPass": 1, "key_pass": 2, "goals": "3.0"}}]}}')
    df = spark.createDataFrame([(1, "H", "V", "2025", "L", text)],
                               "id_jogo long, casa string, fora string, temporada string, campeonato string, doc string")
    (r,) = documents.widen(documents.flatten_lineups(df), schemas.PLAYER_STATS).collect()
    assert (r.key_pass, r.goals) == (2, 3)


def test_incident_documents(spark):
    goal = {"incidentType": "goal", "homeScore": {"display": 1}, "awayScore": 0, "isHome": True,
            "time": 10, "bodyPart": "head"}
    doc = {"incidents": [
        {"incidentType": "card", "time": 1},
        goal,
        goal | {"homeScore": 2, "footballPassingNetworkAction": [
            {"eventType": "pass", "time": 30},
            {"eventType": "goal", "isHome": False, "time": 33, "bodyPart": "left-foot"}]},
        goal | {"footballPassingNetworkAction": [{"eventType": "pass"}]},
        {"incidentType": "goal", "footballPassingNetworkAction": []}]}
    got = [tuple(r)[3:] for r in documents.flatten_goals(doc_frame(spark, doc, {}))
           .orderBy("ordem").collect()]
    assert got == [("H", 10, "head", "1-0", 1), ("V", 33, "left-foot", "2-0", 2), ("V", 0, "", "0-0", 4)]


# --- sinks --------------------------------------------------------------------------
def test_fill_blanks_keeps_what_is_there(spark, matches):
    stored = spark.createDataFrame(
        [match(1, "2025-01-01", "A", "B", 1, 0, odds=(None, "3.00", None), pais=" "),
         match(2, "2025-01-01", "A", "B", 1, 0, odds=("1.10", None, None), pais="")], schemas.MATCHES)
    incoming = spark.createDataFrame(
        [match(1, "2030-01-01", "X", "Y", 9, 9, odds=("5.00", "6.00", None), pais="Chile"),
         match(2, "2030-01-01", "X", "Y", 9, 9, pais="Desconhecido"),
         match(3, "2030-01-01", "X", "Y", 9, 9)], schemas.MATCHES)
    got = rows(sinks.fill_blanks(stored, incoming), "id_jogo")
    assert set(got) == {1, 2}
    assert (got[1].pais, got[1].odd_casa, got[1].odd_empate, got[1].odd_fora) == (
        "Chile", Decimal("5.00"), Decimal("3.00"), None)
    assert (got[1].casa, got[1].gols_casa) == ("A", 1)
    assert got[2].pais == "" and got[2].odd_casa == Decimal("1.10")


def test_upsert_and_insert_ignore(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id_jogo long, v string, t int")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "id_jogo long, v string, t int")
    got = rows(sinks.upsert(old, new, order=[F.col("t").desc()]), "id_jogo")
    assert {k: r.v for k, r in got.items()} == {1: "a", 2: "d", 3: "e"}
    kept = sinks.insert_ignore(new, old, ["id_jogo"], [F.col("t")]).collect()
    assert [(r.id_jogo, r.v) for r in kept] == [(3, "e")]


def test_append_counts_and_inserts_only_new_rows(spark, matches, tmp_path):
    path = str(tmp_path / "t")
    by = ["temporada"]
    assert sinks.append_counted(matches.filter("id_jogo <= 4"), path, by) == 4
    assert sinks.insert_new(matches, path, partition_by=by) == 6
    assert sinks.insert_new(matches, path, partition_by=by) == 0
    assert {r.temporada for r in spark.read.parquet(path).collect()} == {"2025", "2020/2021"}
    assert spark.read.parquet(path).count() == len(MATCHES)


def test_first_load_and_repeated_ids(spark, tmp_path):
    path = str(tmp_path / "new")
    rows_ = [match(1, "2025-01-01", "A", "B", 1, 0), match(1, None, "A", "B", 1, 0), match(2, "2025-01-01", "C", "D", 1, 0)]
    df = spark.createDataFrame(rows_, schemas.MATCHES)
    assert sinks.insert_new(df, path) == 2 and sinks.insert_new(df, path) == 0
    got = rows(spark.read.parquet(path), "id_jogo")
    assert set(got) == {1, 2} and got[1].data is not None  # the fuller copy is kept


def test_zero_odds_are_blank_and_repeats_do_not_multiply(spark):
    stored = spark.createDataFrame([match(1, "2025-01-01", "A", "B", 1, 0, odds=("0.00", "3.00", None))], schemas.MATCHES)
    incoming = spark.createDataFrame([match(1, "2025-01-01", "A", "B", 1, 0, odds=("0.00", "0.00", "0.00")),
                                      match(1, "2025-01-01", "A", "B", 1, 0, odds=("2.00", None, None))], schemas.MATCHES)
    (r,) = sinks.fill_blanks(stored, incoming).collect()
    assert (r.odd_casa, r.odd_empate, r.odd_fora) == (Decimal("2.00"), Decimal("3.00"), None)


def test_changes_are_written_by_season(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [match(1, "2025-01-01", "A", "B", 1, 0), match(2, "2024-01-01", "A", "B", 1, 0, temporada="2024")]
    spark.createDataFrame(old, schemas.MATCHES).write.partitionBy("temporada").parquet(path)
    new = spark.createDataFrame([match(1, "2025-01-01", "A", "B", 9, 9), match(3, "2025-01-02", "E", "F", 0, 0)], schemas.MATCHES)
    before = {f.name for f in (tmp_path / "t" / "temporada=2024").iterdir()}
    sinks.write_changed(new, path, "temporada")
    got = rows(spark.read.schema(schemas.MATCHES).parquet(path), "id_jogo")
    assert {k: r.gols_casa for k, r in got.items()} == {1: 9, 2: 1, 3: 0}
    assert {f.name for f in (tmp_path / "t" / "temporada=2024").iterdir()} == before
    moved = new.withColumns({"temporada": F.when(F.col("id_jogo") == 1, "2023/24"), "gols_casa": F.lit(5)})
    sinks.write_changed(moved, path, "temporada")
    got = rows(spark.read.schema(schemas.MATCHES).parquet(path), "id_jogo")
    assert {k: (r.temporada, r.gols_casa) for k, r in got.items()} == {1: ("2023/24", 5), 2: ("2024", 1), 3: (None, 5)}
    assert not (tmp_path / "t" / "temporada=2025").exists()  # its last rows moved away
    sinks.write_changed(new.filter("id_jogo = 1"), path, "temporada")
    assert sorted(f.name for f in (tmp_path / "t").iterdir() if f.is_dir()) == [
        "temporada=2024", "temporada=2025", "temporada=__HIVE_DEFAULT_PARTITION__"]


def test_reports_and_goal_export(spark, tmp_path):
    df = spark.createDataFrame([(2, 5), (1, 9), (1, 3)], "id_jogo long, minutos int")
    sinks.save_reports({"a": df, "b": df}, str(tmp_path / "r"), "csv")
    sinks.save_reports({"a": df.limit(1)}, str(tmp_path / "r"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "r" / "a")).count() == 1
    sinks.export_goals(df.coalesce(1), str(tmp_path / "g"))
    got = spark.read.schema("id_jogo long, minutos int").option("header", True).csv(str(tmp_path / "g"))
    assert sorted(map(tuple, got.collect())) == [(1, 3), (1, 9), (2, 5)]


def test_align_to_schema(spark):
    df = spark.createDataFrame([("x", 1)], "clube string, sobra int")
    out = sinks.align(df, schemas.TEAM_STATS, {"passes": F.lit(0)})
    assert out.schema == schemas.TEAM_STATS or [f.name for f in out.schema] == [
        f.name for f in schemas.TEAM_STATS]
    r = out.first()
    assert (r.clube, r.passes, r.tackles) == ("x", 0, None)


# --- incremental load -----------------------------------------------------------------
def test_incremental_load(spark, tmp_path):
    landing, log, state = (str(tmp_path / n) for n in ("landing", "log", "state"))

    def land(*data):
        spark.createDataFrame(list(data), schemas.MATCHES).write.mode("append").option(
            "header", True).csv(landing)
        incremental.load_match_csv(spark, landing, log, state).awaitTermination()

    def now():
        return rows(incremental.current_matches(incremental.read_log(spark, log)), "id_jogo")

    land(match(1, "2025-01-01", "A", "B", 1, 0, odds=(None, "3.00", None), pais=None),
         match(1, "2025-01-01", "A", "B", 1, 0, odds=(None, "3.00", None), pais=None),
         match(2, "2025-01-01", "C", "D", 1, 0, pais="Desconhecido"))
    assert set(now()) == {1, 2}
    land(match(1, "2025-01-01", "Z", "Z", 9, 9, odds=("2.50", "9.00", None), pais="Chile"),
         match(2, "2025-01-01", "Z", "Z", 9, 9, pais="Chile"),
         match(3, "2025-01-02", "E", "F", 0, 0))
    got = now()
    assert set(got) == {1, 2, 3}
    assert (got[1].casa, got[1].odd_casa, got[1].odd_empate, got[1].pais) == (
        "A", Decimal("2.50"), Decimal("3.00"), "Chile")
    assert (got[2].pais, got[2].casa) == ("Desconhecido", "C")
    # match 2 brought nothing new, so the log did not grow by it
    assert incremental.read_log(spark, log).filter("id_jogo = 2").count() == 1
    before = incremental.read_log(spark, log).count()
    incremental.load_match_csv(spark, landing, log, state).awaitTermination()
    assert incremental.read_log(spark, log).count() == before


def test_replayed_batch_replaces_itself(spark, tmp_path):
    log = str(tmp_path / "log")
    incremental.create_log(spark, log)
    batch = spark.createDataFrame([match(1, "2025-01-01", "A", "B", 1, 0)], schemas.MATCHES)
    incremental.store_batch(batch, 0, log)
    incremental.store_batch(batch, 0, log)
    assert incremental.read_log(spark, log).count() == 1
    incremental.store_batch(batch, 1, log)
    assert incremental.read_log(spark, log).count() == 1


def test_two_loaders_and_a_renewed_checkpoint_share_a_log(spark, tmp_path):
    log = str(tmp_path / "log")
    events = tmp_path / "events"
    events.mkdir()
    event = lambda i: {"id": i, "startTimestamp": 1741570200, "homeTeam": {"name": "A"}, "awayTeam": {"name": "B"}}
    lines = [json.dumps({"evento": event(i), "temporada": "2025"}) for i in (1, 2)] + ['{"evento": {"id": 3', '{"evento": {}}']
    write(events / "a.json", "\n".join(lines))
    incremental.load_events(spark, str(events), log, str(tmp_path / "s1")).awaitTermination()
    rows_ = spark.createDataFrame([match(9, "2025-01-01", "A", "B", 1, 0), match(2, "2025-01-01", "X", "Y", 1, 0)], schemas.MATCHES)
    rows_.write.option("header", True).csv(str(tmp_path / "csv"))
    incremental.load_match_csv(spark, str(tmp_path / "csv"), log, str(tmp_path / "s2")).awaitTermination()
    incremental.load_match_csv(spark, str(tmp_path / "csv"), log, str(tmp_path / "s3")).awaitTermination()
    got = rows(incremental.current_matches(incremental.read_log(spark, log)), "id_jogo")
    assert set(got) == {1, 2, 9} and got[2].casa == "A" and got[2].odd_casa == Decimal("2.00")
    assert sorted(r.linha for r in spark.read.parquet(incremental.rejected_dir(log)).collect()) == ['{"evento": {"id": 3', "{}"]
    incremental.compact_log(spark, log, str(tmp_path / "small"))
    small = incremental.current_matches(incremental.read_log(spark, str(tmp_path / "small")))
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, got.values()), key=str)


def test_the_fullest_copy_of_a_batch_wins(spark):
    batch = spark.createDataFrame([match(1, None, "A", "B", None, None), match(1, "2025-01-01", "A", "B", 1, 0)], schemas.MATCHES)
    (r,) = incremental.merge_batch(batch).collect()
    assert (r.data, r.gols_casa) == (datetime.date(2025, 1, 1), 1)


def test_lookups_read_only_the_batchs_seasons(spark, tmp_path):
    log = str(tmp_path / "log")
    incremental.create_log(spark, log)
    for i, season in enumerate(("2024", "2025")):
        incremental.store_batch(spark.createDataFrame(
            [match(i, "2025-01-01", "A", "B", 1, 0, temporada=season)], schemas.MATCHES), i, log)
    some = incremental._of_seasons(incremental.read_log(spark, log), incremental.read_log(spark, log).filter("temporada = '2025'"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "temporada" in plan.split("PartitionFilters")[1] and some.count() == 1


def test_lineup_documents_are_built_as_compiled_text(spark, tmp_path):
    from verification import docs

    lines = spark.createDataFrame([(1, 7, 2, 5.0), (2, None, 5, None), (3, 9, None, 4.0)], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double")
    made = docs.lineup_docs(spark, str(tmp_path), lines)
    full, bare, unplaced = [json.loads(r.doc) for r in made.orderBy("id_jogo").collect()]
    assert full["home"]["players"][1] == {
        "player": {"id": 8, "name": "P7", "position": "M", "jerseyNumber": "3", "height": 172, "country": {"name": "Brazil"}},
        "substitute": False, "captain": False, "statistics": {
            "minutesPlayed": "5.0", "goals": 2, "bigChanceCreated": 0, "key_pass": 99, "keyPass": 5, "ratingVersions": {"original": 55}}}
    assert bare["away"]["players"] == [
        {"player": {"position": "D", "jerseyNumber": "7", "height": 175, "country": {"name": "Brazil"}},
         "substitute": True, "captain": False, "statistics": {"key_pass": 99, "ratingVersions": {}}}]
    assert set(unplaced["away"]["players"][0]["player"]) == {"id", "name", "country"}
    assert [r.position for r in documents.flatten_lineups(made).filter("id_jogo = 3").collect()] == [None] * 3
    plan = documents.flatten_lineups(made)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("from_json" in step and "l_quantity" in step for step in plan.split("\n"))


@pytest.mark.parametrize("broken", [0, 2])
def test_a_batch_is_read_once_where_it_has_no_bad_line(spark, tmp_path, broken):
    log, read = str(tmp_path / "log"), spark.sparkContext.accumulator(0)
    incremental.create_log(spark, log)
    keys = [1, 2, 3, 3] + [None] * broken

    def row(k):
        read.add(1)
        return (k, "A", "2024", f"line {k}")

    batch = spark.createDataFrame(
        spark.sparkContext.parallelize(keys, 2).map(row), "id_jogo long, casa string, temporada string, _linha string")
    incremental.store_batch(batch, 0, log)
    assert read.value == len(keys) * (2 if broken else 1)
    assert [r.linha for r in spark.read.parquet(incremental.rejected_dir(log)).collect()] == ["line None"] * broken
    now = incremental.current_matches(incremental.read_log(spark, log))
    assert sorted(r.id_jogo for r in now.collect()) == [1, 2, 3]
    plan = now._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Sort [") == 1  # rows are sorted once, after the shuffle
