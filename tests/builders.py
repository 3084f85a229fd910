"""Rows that several test modules share."""

import datetime
from decimal import Decimal


def match(id_, day, home, away, hg, ag, *, odds=("2.00", "3.00", "4.00"), hora="16:00",
          temporada="2025", campeonato="Liga", pais="Brasil"):
    o = [Decimal(x) if x is not None else None for x in odds]
    return (id_, datetime.date.fromisoformat(day) if day else None, hora, pais, campeonato, "1",
            home, away, hg, ag, temporada, o[0], o[1], o[2], datetime.datetime(2025, 1, 1))


MATCHES = [
    match(1, "2025-01-05", "A", "B", 4, 0, odds=("1.50", "3.00", "5.00")),   # haul at home
    match(2, "2025-01-08", "B", "A", 1, 1, odds=("2.01", "3.00", "3.00")),   # draw, mutual
    match(3, "2025-01-10", "A", "C", 0, 0, odds=("1.01", None, None)),        # 0-0, odds on the edge
    match(4, "2025-01-12", "C", "A", 1, 5, odds=("1.00", "3.00", "50.01")),   # haul away, odds too low
    match(5, "2025-01-12", "A", "D", 1, 2, hora="19:00"),                       # same date, later hour
    match(6, "2025-01-20", "A", "B", None, None),                               # unplayed
    match(7, "2025-02-01", "D", "E", 2, 0, pais="Mundo"),                      # E: a single game, lost
    match(8, "2025-02-02", "B", "D", 2, 1, temporada="2020/2021", odds=(None, None, None)),
    match(9, "2025-02-03", "B", "C", 3, 0, pais="Mundo"),
    match(10, "2025-02-04", "C", "B", 0, 1, pais="Argentina"),
]


def rows(df, *key):
    """Rows by key."""
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}
