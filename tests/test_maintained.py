import datetime
import random

import pytest
from pyspark.sql import functions as F

from builders import match
from pitchlake import schemas
from pitchlake.operators import maintained, streaks
from pitchlake.operators.club_games import club_games, last_n
from pitchlake.session import materialise


def season(seed, n=120, clubs=5):
    rng = random.Random(seed)
    start = datetime.date(2025, 1, 1)
    out = []
    for i in range(n):
        a, b = rng.sample(range(clubs), 2)
        day = str(start + datetime.timedelta(days=rng.randrange(200))) if rng.random() > 0.03 else None
        out.append(match(i, day, f"C{a}", f"C{b}", rng.choice([0, 0, 1, 1, 2, None]), rng.choice([0, 1]), hora=rng.choice(["16:00", "20:00"])))
    return out


def deliveries(seed):
    """Random deliveries: late games, corrections of score, date and clubs, matches taken back."""
    rng = random.Random(seed)
    truth, parts = {}, []
    games = season(seed)
    rng.shuffle(games)
    for k in range(4):
        part = games[k * 30:(k + 1) * 30]
        for old in rng.sample(sorted(truth), min(len(truth), 15)):
            new = list(truth[old])
            new[1] = datetime.date(2025, 1, 1) + datetime.timedelta(days=rng.randrange(200))
            new[8] = rng.choice([None, 0, 1, 2])
            if rng.random() < 0.3:
                new[6], new[7] = new[7], f"C{rng.randrange(5)}X"
            part.append(tuple(new))
        for m in part:
            truth[m[0]] = m
        parts.append(part)
    return parts, list(truth.values())


def window(df):
    return sorted((r.clube, r.id_jogo, r.gols_marcados) for r in df.collect())


@pytest.mark.parametrize("seed,reserve", [(1, 10), (2, 0), (3, 2)])
def test_recent_games_equal_the_whole_recomputation(spark, seed, reserve):
    parts, truth = deliveries(seed)
    frame = lambda r: spark.createDataFrame(r, schemas.MATCHES)
    state = materialise(maintained.recent_state(frame(parts[0]), n=4, reserve=reserve), "t")
    for part in parts[1:]:
        state = materialise(maintained.updated(state, frame(part), n=4, reserve=reserve), "t")
    want = last_n(club_games(frame(truth)), 4)
    exact = {r.clube for r in state.filter("completo").collect()}
    short = [w for w in window(maintained.recent_games(state, n=4)) if w[0] in exact]
    assert short == [w for w in window(want) if w[0] in exact]  # exact without a look at history
    assert window(maintained.recent_games(maintained.refilled(state, frame(truth), n=4, reserve=reserve), n=4)) == window(want)
    assert state.agg(F.max(F.size("jogos"))).first()[0] <= 4 + reserve


def test_update_reads_neither_history_nor_a_stored_table(spark):
    parts, _ = deliveries(5)
    frame = lambda r: spark.createDataFrame(r, schemas.MATCHES)
    state = maintained.recent_state(frame(parts[0][:0]))
    for part in parts:
        state = materialise(maintained.updated(state, frame(part)), "t")
    assert state.count() > 4
    plan = maintained.updated(state, frame(parts[0]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Scan parquet" in plan


@pytest.mark.parametrize("seed,kind", [(11, streaks.UNBEATEN), (12, streaks.WINNING)])
def test_runs_equal_after_any_deliveries(spark, seed, kind):
    parts, truth = deliveries(seed)
    frame = lambda r: spark.createDataFrame(r, schemas.MATCHES)
    known: dict = {}
    state = maintained.blocks(club_games(frame([])), kind)
    for part in parts:
        state = materialise(maintained.update_blocks(state, frame(list(known.values())), frame(part), kind), "t")
        known.update({m[0]: m for m in part})
    got = sorted(map(tuple, maintained.runs(state).collect()))
    assert got == sorted(map(tuple, streaks.runs(club_games(frame(truth)), kind).collect()))


def test_merging_is_associative(spark):
    rng = random.Random(4)
    for _ in range(3):
        games = [int(rng.random() < 0.7) for _ in range(24)]

        def summary(part):
            runs = "".join(map(str, part)).split("0")
            return (len(part), len(runs[0]), len(runs[-1]), max(map(len, runs)))

        cuts = sorted(rng.sample(range(1, 24), 5))
        parts = [games[i:j] for i, j in zip([0, *cuts], [*cuts, 24])]
        schema = "clube string, mes int, comprimento long, inicio long, fim long, maior long"
        rows = [("A", i, *summary(p)) for i, p in enumerate(parts)]
        whole = maintained.merged(spark.createDataFrame(rows, schema)).first()
        assert tuple(whole)[2:] == summary(games)
        some = maintained.merged(spark.createDataFrame(rows[:3], schema)).unionByName(
            maintained.merged(spark.createDataFrame(rows[3:], schema)))
        assert tuple(maintained.merged(some).first())[2:] == summary(games)
