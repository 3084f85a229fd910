"""Column contracts of the tables and of the source documents."""

import re

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(), "DECIMAL(8,2)": T.DecimalType(8, 2),
    "DECIMAL(18,2)": T.DecimalType(18, 2),
}


def _table(columns: str) -> T.StructType:
    """Flat schema from 'name TYPE, ...' text; works before a session exists."""
    pairs = [c.split() for c in re.split(r",\s*(?![^()]*\))", columns.strip())]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


MATCHES = _table("""
    id_jogo BIGINT, data DATE, hora STRING, pais STRING, campeonato STRING, rodada STRING,
    casa STRING, fora STRING, gols_casa INT, gols_fora INT, temporada STRING,
    odd_casa DECIMAL(8,2), odd_empate DECIMAL(8,2), odd_fora DECIMAL(8,2),
    cadastrado_em TIMESTAMP
""")

TEAM_STATS = _table("""
    id_jogo BIGINT, periodo STRING, clube STRING, temporada STRING,
    ball_possession STRING, duels STRING, tackles_won STRING, crosses STRING,
    long_balls STRING, ground_duels STRING, aerial_duels STRING, expected_goals DOUBLE,
    big_chances INT, big_chances_scored INT, big_chances_missed INT, total_shots INT,
    shots_on_target INT, shots_off_target INT, blocked_shots INT, shots_inside_box INT,
    shots_outside_box INT, hit_woodwork INT, corner_kicks INT, passes INT,
    accurate_passes INT, through_balls INT, final_third_entries INT,
    fouled_in_final_third INT, dispossessed INT, tackles INT, interceptions INT,
    recoveries INT, clearances INT, goalkeeper_saves INT, yellow_cards INT, red_cards INT
""")

PLAYER_STATS = _table("""
    id_jogo BIGINT, team STRING, player_id BIGINT, name STRING, position STRING,
    jersey_number INT, height INT, date_of_birth_timestamp BIGINT, country STRING,
    value DECIMAL(18,2), substitute BOOLEAN, captain BOOLEAN, rating DOUBLE,
    minutes_played INT, goals INT, goal_assist INT, big_chance_created INT, key_pass INT,
    expected_goals DOUBLE, fouls INT, penalty_conceded INT, error_lead_to_a_shot INT,
    error_lead_to_a_goal INT, touches INT, total_pass INT, accurate_pass INT,
    temporada STRING
""")

GOALS = _table("""
    id_jogo BIGINT, temporada STRING, campeonato STRING, clube_gol STRING, minutos INT,
    forma_gol STRING, placar STRING, cadastrado_em TIMESTAMP
""")

HISTORY = _table("""
    data DATE, campeonato STRING, temporada STRING, casa STRING, gols_casa INT,
    gols_fora INT, fora STRING, cadastrado_em TIMESTAMP
""")

# Source documents (JSON text), read with from_json.
EVENT_DOC = """
    id BIGINT, startTimestamp BIGINT, tournament STRUCT<name: STRING>,
    roundInfo STRUCT<name: STRING, round: STRING>,
    homeTeam STRUCT<id: BIGINT, name: STRING>, awayTeam STRUCT<id: BIGINT, name: STRING>,
    homeScore STRUCT<normaltime: INT, current: INT>,
    awayScore STRUCT<normaltime: INT, current: INT>
"""
STATISTICS_DOC = """
    statistics ARRAY<STRUCT<period: STRING, groups: ARRAY<STRUCT<
        statisticsItems: ARRAY<STRUCT<name: STRING, home: STRING, away: STRING>>>>>>
"""
_PLAYERS = """STRUCT<players: ARRAY<STRUCT<
    player: STRUCT<id: BIGINT, name: STRING, position: STRING, jerseyNumber: STRING,
        height: INT, dateOfBirthTimestamp: BIGINT, country: STRUCT<name: STRING>,
        proposedMarketValueRaw: STRUCT<value: DOUBLE>>,
    substitute: BOOLEAN, captain: BOOLEAN, statistics: MAP<STRING, STRING>>>>"""
LINEUPS_DOC = f"home {_PLAYERS}, away {_PLAYERS}"
INCIDENTS_DOC = """
    incidents ARRAY<STRUCT<incidentType: STRING, homeScore: STRING, awayScore: STRING,
        isHome: BOOLEAN, time: INT, bodyPart: STRING,
        footballPassingNetworkAction: ARRAY<STRUCT<
            eventType: STRING, isHome: BOOLEAN, time: INT, bodyPart: STRING>>>>
"""
