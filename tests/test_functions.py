import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pitchlake.functions import fixed, labels, numeric, text


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


@pytest.mark.parametrize("won,drawn,games,share", [(4, 4, 11, 48.48), (12, 1, 14, 88.10)])
def test_points_share(spark, won, drawn, games, share):
    assert one(spark, numeric.pct(F.lit(won * 3 + drawn), F.lit(games * 3)))[0] == share


def test_percentages_of_the_rendered_report(spark):
    cases = [(8, 11, 72.73), (11, 14, 78.57), (5, 14, 35.71), (5, 13, 38.46), (8, 24, 33.33),
             (1815, 2148, 84.50), (11, 65, 16.92)]
    got = one(spark, *[numeric.pct(F.lit(a), F.lit(b)) for a, b, _ in cases])
    assert list(got) == [c for *_, c in cases]


def test_card_cells_truncate_integers(spark):
    got = one(
        spark,
        numeric.card_text(numeric.pct(F.lit(19), F.lit(44)), F.lit(False)),
        numeric.card_text(numeric.pct(F.lit(40), F.lit(97)), F.lit(False)),
        numeric.card_text(numeric.ratio(F.lit(13), F.lit(10)), F.lit(False)),
        numeric.card_text(F.lit(7), F.lit(True)),
        numeric.card_text(F.lit(None).cast("double"), F.lit(True)),
    )
    assert list(got) == ["43", "41", "1", "7.00", ""]


def test_rounding_is_half_up_on_decimals_and_zero_safe(spark):
    got = one(
        spark, numeric.ratio(F.lit(201), F.lit(200)), numeric.ratio(F.lit(-201), F.lit(200)),
        numeric.ratio(F.lit(1), F.lit(0)), numeric.pct(F.lit(1), F.lit(0)),
        numeric.truncated(F.lit(-7), F.lit(2)),
    )
    assert list(got) == [1.01, -1.01, None, 0.0, -3]


def test_sum_of_nothing_is_zero(spark):
    empty = spark.range(0)
    assert empty.agg(numeric.total(F.col("id")), numeric.mean(F.col("id"))).first()[:] == (0, None)


def test_text_numbers(spark):
    got = one(
        spark, text.percent(F.lit("54%")), text.percent(F.lit("54,3%")), text.percent(F.lit("n/d")),
        text.won_of_total(F.lit("5/16 (31%)")), text.won_of_total(F.lit("0/0 (0%)")),
        text.won_of_total(F.lit("bad")), text.number(F.lit("x"), "int", 0),
        text.blank_to_null(F.lit("NaN")), text.finite(F.lit(float("inf"))),
        numeric.brazilian_number(F.lit(1234.5), 2, "€ "),
    )
    assert list(got[:3]) == [54.0, 54.3, None]
    assert tuple(got[3]) == (5, 16, 31.25)
    assert tuple(got[4]) == (0, 0, None)
    assert tuple(got[5]) == (None, None, None)
    assert list(got[6:]) == [0, None, None, "€ 1.234,50"]


def test_dates(spark):
    d = datetime.date(2025, 3, 9)
    texts = ["2025-03-09", " 2025-03-09 21:00", "09/03/2025", "09/03/2025 10:00", " 09-03-2025\r\n",
             "09-03-2025 10:00", "2025-13-40", "soon"]
    got = one(spark, *[text.parse_date(F.lit(t)) for t in texts])
    assert list(got) == [d, d, d, d, d, None, None, None]


def test_kickoff_changes_day_at_utc_minus_3(spark):
    epoch = F.lit(int(datetime.datetime(2025, 3, 10, 1, 30, tzinfo=datetime.UTC).timestamp()))
    assert list(one(spark, text.local_date(epoch), text.local_time(epoch))) == [
        datetime.date(2025, 3, 9), "22:30"]


def test_names_and_links(spark):
    got = one(
        spark,
        text.metric_column(F.lit("Fouled (in final third)")), text.snake_case(F.lit("bigChanceCreated")),
        text.header_token(F.lit("﻿ Gols-Mandánte ")), text.competition_key(F.lit(" Copa , Rodada")),
        text.round_number(F.lit("Rodada 12"), F.lit("3")), text.round_number(F.lit(None), F.lit("3")),
        text.round_number(F.lit("Final"), F.lit(None)),
        text.clean_link(F.lit("'https://x.y/a#id:55',")), text.clean_link(F.lit("# Rodada")),
        text.clean_link(F.lit("ftp://x")), text.link_match_id(F.lit("https://x.y/a#id:55")),
        text.link_match_id(F.lit("https://x.y/a")),
    )
    assert list(got) == ["fouled_in_final_third", "big_chance_created", "gols_mandante", "Copa", "12",
                         "3", "0", "https://x.y/a#id:55", None, None, 55, None]


def test_odds_band_edges(spark):
    values = [None, "1.00", "1.01", "1.50", "1.51", "2.00", "50.00", "50.01", "999.00"]
    cols = [labels.odds_band(F.lit(v).cast("decimal(8,2)")) for v in values]
    got = [b and b["ordem"] for b in one(spark, *cols)]
    assert got == [None, None, 1, 1, 2, 2, 10, 11, 11]
    assert len(fixed.ODDS_BAND_NAMES) == 11


def test_match_labels(matches):
    got = {
        r["id_jogo"]: tuple(r)[1:]
        for r in matches.select(
            "id_jogo", labels.winner(), labels.loser(), labels.winner_odds(), labels.points("Casa"),
            labels.points("Fora"), labels.scoreline(), labels.side_of(F.lit("A")),
            labels.opponent_of(F.lit("A")),
        ).collect()
    }
    assert got[1] == ("A", "B", Decimal("1.50"), 3, 0, "4-0", "Casa", "B")
    assert got[2] == ("Empate", "Empate", None, 1, 1, "1-1", "Fora", "B")
    assert got[6] == (None, None, None, None, None, "0-0", "Casa", "B")
    assert got[9][-2:] == ("Verificar", None)


def test_mutual_match_belongs_to_both_clubs(matches):
    got = matches.select("id_jogo", F.explode(labels.analysed_clubs("A", "B")).alias("c")).collect()
    assert sorted(r["c"] for r in got if r["id_jogo"] == 1) == ["A", "B"]
    assert [r["c"] for r in got if r["id_jogo"] == 3] == ["A"]


def test_positions_and_age(spark):
    got = one(
        spark, labels.position_name(F.lit("D")), labels.position_name(F.lit("Z")),
        labels.position_order(F.lit("Atacante")),
        labels.age_in_years(F.lit(0), F.lit("2000-01-01").cast("date")),
    )
    assert list(got) == ["Defensor", "Verificar", 4, 29]
