import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from builders import match, rows
from pitchlake import schemas
from pitchlake.functions import fixed
from pitchlake.operators import club_games as cg
from pitchlake.operators import reports, results, streaks
from pitchlake.sources import tables


def test_club_games_has_two_rows_per_played_match(matches):
    games = cg.club_games(matches)
    assert games.count() == 2 * 9
    t = games.agg(*[F.sum(c).alias(c) for c in
                    ("venceu", "perdeu", "gols_marcados", "gols_sofridos")]).first()
    assert t["venceu"] == t["perdeu"] and t["gols_marcados"] == t["gols_sofridos"]


def test_season_card(matches):
    games = cg.club_games(tables.matches_in(matches, "2025"))
    a = rows(results.season_card(games), "clube")["A"]
    assert (a.jogos, a.vitorias, a.empates, a.derrotas) == (5, 2, 2, 1)
    assert (a.gols_marcados, a.gols_sofridos) == (11, 4)
    assert a.aproveitamento == 53.33
    assert (a.over_2_5, a.under_2_5, a.prob_over_2_5) == (3, 2, 60.0)
    # home mean (1.50 + 1.01 + 2.00) / 3, away mean (3.00 + 50.01) / 2, then the mean of both
    assert a.odd_media == 14.0
    assert a.odd_media_vitoria == 25.76      # (1.50 + 50.01) / 2
    assert (a.goleadas, a.goleadas_mandante, a.goleadas_visitante) == (2, 1, 1)


def test_winner_odds_with_wins_on_one_side_only(matches):
    games = cg.club_games(tables.matches_in(matches, "2025"))
    d = rows(results.season_card(games), "clube")["D"]
    assert d.vitorias == 2 and d.odd_media_vitoria == 3.0
    e = rows(results.season_card(games), "clube")["E"]
    assert e.vitorias == 0 and e.odd_media_vitoria is None


def test_last_n_takes_the_later_hour_of_a_date(matches):
    last = cg.last_n(cg.club_games(matches).filter("clube = 'A'"), 2).select("id_jogo").collect()
    assert sorted(r.id_jogo for r in last) == [4, 5]


def test_last_n_with_one_club_holding_most_rows(spark):
    data = [match(i, None if i % 50 == 0 else str(datetime.date(2020, 1, 1) + datetime.timedelta(i)),
                  "HOT", f"C{i % 7}", i % 4, i % 3) for i in range(600)]
    games = cg.club_games(spark.createDataFrame(data, schemas.MATCHES).repartition(4))
    last = cg.last_n(games, 10)
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # cut before and after the shuffle
    hot = sorted(r.id_jogo for r in last.filter("clube = 'HOT'").collect())
    assert hot == list(range(590, 600))


def test_clean_games_and_rates(matches):
    a = rows(results.clean_games(cg.club_games(matches), rates=True), "clube")["A"]
    assert (a.clean_sheets, a.clean_goals, a.tx_clean_sheets) == (2, 1, 0.4)


def test_venue_strength(matches):
    games = cg.club_games(matches)
    a = rows(results.venue_strength(games, "Casa"), "clube")["A"]
    assert (a.jogos, a.vitorias, a.empates, a.derrotas) == (3, 1, 1, 1)
    assert (a.media_marcados, a.odd_media, a.odd_media_vitoria) == (1.67, 1.5, 1.5)
    e = rows(results.venue_strength(games, "Fora"), "clube")["E"]
    assert e.odd_media_vitoria == 0.0


def test_head_to_head_counts_both_venues(matches):
    r = results.head_to_head(matches, "A", "B").first()
    assert (r.jogos, r.vitorias_a, r.empates, r.vitorias_b, r.gols_a, r.gols_b) == (2, 1, 1, 0, 5, 1)
    assert (r.media_gols, r.odd_media_a, r.odd_media_b, r.odd_media_vencedor) == (3.0, 2.25, 3.51, 1.5)
    assert results.head_to_head(matches, "A", "E").count() == 0
    same = rows(results.head_to_head(matches), "clube_a", "clube_b")[("A", "B")]
    assert same.gols_a == 5


def test_scorelines_share_of_shown_or_all(matches):
    shown = rows(results.scorelines(matches, k=1), "casa")["A"]
    assert (shown.placar, shown.qtd, shown.prob) == ("0-0", 1, 100.0)
    every = rows(results.scorelines(matches, k=1, denominator="all"), "casa")["A"]
    assert every.prob == 33.33
    with pytest.raises(ValueError):
        results.scorelines(matches, denominator="other")


def test_league_table_is_ranked_without_gaps(matches):
    table = results.league_table(matches).orderBy("posicao").collect()
    assert [r.posicao for r in table] == list(range(1, len(table) + 1))
    keys = [(-r.aproveitamento, -r.vitorias, -r.gols_marcados) for r in table]
    assert keys == sorted(keys)


def test_country_prefers_any_other_to_world(matches):
    country = {r.clube: r.pais for r in results.club_country(cg.club_games(matches)).collect()}
    assert country["E"] == "Mundo"          # seen nowhere else
    assert country["C"] == "Brasil"         # Brasil twice, Argentina once, Mundo once
    table = {r.clube: r.pais for r in results.league_table(matches).collect()}
    assert table == country


def test_country_tie_goes_to_the_first_name(spark):
    data = [match(1, "2025-01-01", "X", "Y", 1, 0, pais="Peru"),
            match(2, "2025-01-02", "X", "Z", 1, 0, pais="Chile")]
    games = cg.club_games(spark.createDataFrame(data, schemas.MATCHES))
    assert rows(results.club_country(games), "clube")["X"].pais == "Chile"


def test_odds_bands_count_valid_sides(matches):
    bands = results.odds_bands(cg.club_games(matches)).collect()
    assert [r.ordem for r in bands] == sorted(r.ordem for r in bands)
    # nine played matches, both sides: 18, less five missing odds and 1.00
    assert sum(r.total_jogos for r in bands) == 18 - 3 - 1
    assert all(r.vitorias + r.derrotas == r.total_jogos for r in bands)


def test_competition_tables(matches):
    card = rows(results.competition_card(matches, ("temporada",)), "temporada")["2025"]
    assert (card.jogos, card.vitorias_casa, card.empates, card.vitorias_fora) == (8, 3, 2, 3)
    assert card.gols == card.gols_casa + card.gols_fora
    goals = results.competition_goals(matches)
    assert results.highest_mean_goals(goals, min_games=3).first().pais == "Brasil"


def test_fewest_wins_lists_clubs_without_any(matches):
    counts = results.club_counts(cg.club_games(matches))
    low = results.extremes(counts, "vitorias", 2).filter("lista = 'menor'").collect()
    assert [(r.clube, r.valor) for r in low] == [("C", 0), ("E", 0)]


def brute_runs(flags):
    best = max((len(list(g)) for ok, g in itertools.groupby(flags) if ok), default=0)
    now = len(list(itertools.takewhile(bool, reversed(flags))))
    return best, now


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_match_brute_force(spark, seed):
    rng = random.Random(seed)
    start = datetime.date(2024, 1, 1)
    data = [
        match(i, str(start + datetime.timedelta(rng.randrange(25))),
              rng.choice(["HOT", "HOT", "X"]), rng.choice(["Y", "Z"]), rng.randrange(3),
              rng.randrange(3), hora=rng.choice(["16:00", "20:00"]))
        for i in range(300)
    ]
    played = sorted(data, key=lambda r: (r[1], r[2], r[0]))
    games = cg.club_games(spark.createDataFrame(data, schemas.MATCHES))
    for kind, ok in ((streaks.UNBEATEN, lambda a, b: a >= b), (streaks.WINNING, lambda a, b: a > b)):
        want = {
            club: brute_runs([ok(r[8], r[9]) if r[6] == club else ok(r[9], r[8])
                              for r in played if club in (r[6], r[7])])
            for club in ("HOT", "X", "Y", "Z")
        }
        for block in (("data", "hora"), ("data",)):
            got = {r.clube: (r.maior, r.atual) for r in streaks.runs(games, kind, block=block).collect()}
            assert got == want


def test_runs_of_clubs_without_breaks_or_hits(matches):
    got = {r.clube: (r.maior, r.atual) for r in streaks.runs(cg.club_games(matches)).collect()}
    assert got["E"] == (0, 0)
    assert got["A"] == (4, 0)
    with pytest.raises(ValueError):
        streaks.runs(cg.club_games(matches), "other")


def test_rank_all_numbers_ties_by_the_rest(spark):
    df = spark.createDataFrame([(50.0, "b"), (50.0, "a"), (75.5, "z"), (0.0, "c")], "p double, n string")
    got = cg.rank_all(df, "p", [F.col("n")]).orderBy("posicao").collect()
    assert [(r.posicao, r.n) for r in got] == [(1, "z"), (2, "a"), (3, "b"), (4, "c")]


def test_min_games_and_last_dates(matches):
    games = cg.club_games(matches)
    assert {r.clube for r in cg.at_least(games, ["clube"], 5).collect()} == {"A", "B"}
    days = cg.last_dates(games.filter("clube = 'A'"), 1, ("clube",))
    assert sorted(r.id_jogo for r in days.collect()) == [4, 5]


def test_cards_side_by_side(matches):
    card = results.season_card(cg.club_games(matches))
    lines = reports.card_rows(card, fixed.SEASON_CARD)
    table = reports.side_by_side(lines, ["A", "B"]).collect()
    assert [r.informacao for r in table] == [label for label, *_ in fixed.SEASON_CARD]
    assert (table[0]["A"], table[6]["A"]) == ("5", "53.33")


def test_scopes(matches):
    ids = lambda df: sorted(r.id_jogo for r in df.collect())
    assert ids(tables.matches_between(matches, "A", "B")) == [1, 2, 6]
    assert ids(tables.matches_of(matches, ["E"])) == [7]
    assert ids(tables.matches_prev_month(matches, "2025-03-15")) == [7, 8, 9, 10]
    assert ids(tables.matches_prev_month(matches, "2025-01-31")) == []
    assert ids(tables.matches_in(matches, "2020/2021")) == [8]
