"""These must stay exactly as they are for results to be right."""

# --- positions: source code and report name, in line-up order ---
POSITIONS = [
    ("G", "Goleiro"),
    ("D", "Defensor"),
    ("M", "Meio-campo"),
    ("F", "Atacante"),
]

# --- odds bands: right-closed edges; the last band has no upper edge ---
ODDS_BAND_EDGES = ["1.01", "1.50", "2.00", "2.50", "3.00", "5.00",
                   "10.00", "20.00", "30.00", "40.00", "50.00"]
ODDS_BAND_NAMES = ["1.01 – 1.50", "1.51 – 2.00", "2.01 – 2.50", "2.51 – 3.00",
                   "3.01 – 5.00", "5.01 – 10.00", "10.01 – 20.00", "20.01 – 30.00",
                   "30.01 – 40.00", "40.01 – 50.00", "50.01+"]

# --- competitions left out of the monthly team tables ---
EXCLUDED_COMPETITIONS = ["Eliminatórias", "Amistoso"]

# --- country labels with a special meaning ---
WORLD = "Mundo"
UNKNOWN_COUNTRY = "Desconhecido"

# --- text that means "no value" in CSV files ---
NULL_TEXTS = ["", "nan", "NaN"]

# --- patterns ---
WON_OF_TOTAL = r"(\d+)\s*/\s*(\d+)"
LINK_MATCH_ID = r"#id:(\d+)"
HTTP_WITH_HOST = r"^(?i:https?)://[^/?#\s]+"

# --- kick-off times are shown at UTC-3 ---
LOCAL_OFFSET_SECONDS = -3 * 3600

# --- link filters ---
INTERNAL_SCHEMES = ["brave://", "chrome://"]
BANNED_LINK_WORDS = ["adiad", "cancel", "postpon", "award"]

# --- accented Latin letters and their plain forms ---

# --- CSV layouts ---
MATCH_BACKUP_COLUMNS = [
    "id", "temporada", "id_jogo", "data", "hora", "campeonato", "pais", "rodada",
    "casa", "fora", "gols_casa", "gols_fora", "odd_casa", "odd_empate", "odd_fora",
    "cadastrado_em",
]
GOAL_COLUMNS = ["id_jogo", "temporada", "campeonato", "clube_gol", "minutos",
                "forma_gol", "placar"]
HISTORY_COLUMNS = ["data", "campeonato", "temporada", "casa", "gols_casa", "gols_fora", "fora"]
HISTORY_KEY = ["data", "temporada", "casa", "gols_casa", "gols_fora", "fora"]
HISTORY_HEADER_SYNONYMS = {
    "data": ["data", "dt", "date"],
    "campeonato": ["campeonato", "competicao", "competicao_nome", "torneio"],
    "temporada": ["temporada", "season", "ano"],
    "casa": ["casa", "mandante", "home", "time_casa", "time_mandante"],
    "gols_casa": ["gols_casa", "gols_mandante", "placar_casa", "gols_home", "home_goals"],
    "gols_fora": ["gols_fora", "gols_visitante", "placar_fora", "gols_away", "away_goals"],
    "fora": ["fora", "visitante", "away", "time_fora", "time_visitante"],
}
ODDS_COLUMNS = ["Mandante", "Visitante", "Gol_Mandante", "Gol_Visitante",
                "Odd_1", "Odd_X", "Odd_2"]
SEPARATORS = [";", ",", "\t", "|"]

# --- report cards: (report label, column, shown with two decimals) ---
SEASON_CARD = [
    ("Jogos", "jogos", False),
    ("Vitórias", "vitorias", False),
    ("Empates", "empates", False),
    ("Derrotas", "derrotas", False),
    ("Gols marcados", "gols_marcados", False),
    ("Gols sofridos", "gols_sofridos", False),
    ("Aproveitamento", "aproveitamento", True),
    ("Over 2.5 gols", "over_2_5", False),
    ("Probabilidade de over 2.5 gols", "prob_over_2_5", True),
    ("Under 2.5 gols", "under_2_5", False),
    ("Probabilidade de under 2.5 gols", "prob_under_2_5", True),
    ("Odd média", "odd_media", True),
    ("Odd média quando venceu", "odd_media_vitoria", True),
    ("Goleadas", "goleadas", False),
    ("Probabilidade de golear", "prob_golear", True),
    ("Goleadas como mandante", "goleadas_mandante", False),
    ("Goleadas como visitante", "goleadas_visitante", False),
]
STRENGTH_CARD = [
    ("Jogos", "jogos", False),
    ("Vitórias", "vitorias", False),
    ("Empates", "empates", False),
    ("Derrotas", "derrotas", False),
    ("Gols marcados", "gols_marcados", False),
    ("Gols sofridos", "gols_sofridos", False),
    ("Aproveitamento", "aproveitamento", True),
    ("Média de gols marcados", "media_marcados", True),
    ("Média de gols sofridos", "media_sofridos", True),
    ("Clean sheets", "clean_sheets", False),
    ("Clean goals", "clean_goals", False),
    ("Odd média", "odd_media", True),
    ("Odd média quando venceu", "odd_media_vitoria", True),
]
COMPETITION_CARD = [
    ("Jogos", "jogos", False),
    ("Vitórias do mandante", "vitorias_casa", False),
    ("Probabilidade de vitória do mandante", "prob_vitorias_casa", True),
    ("Odd média do time mandante", "odd_media_casa", True),
    ("Odd média quando o mandante venceu", "odd_media_vitoria_casa", True),
    ("Gols do mandante", "gols_casa", False),
    ("Média de gols do mandante", "media_gols_casa", True),
    ("Empates", "empates", False),
    ("Vitórias do visitante", "vitorias_fora", False),
    ("Probabilidade de vitória do visitante", "prob_vitorias_fora", True),
    ("Odd média do time visitante", "odd_media_fora", True),
    ("Odd média quando o visitante venceu", "odd_media_vitoria_fora", True),
    ("Gols do visitante", "gols_fora", False),
    ("Média de gols do visitante", "media_gols_fora", True),
    ("Total de gols", "gols", False),
    ("Média de gols geral", "media_gols", True),
    ("Odd média dos vencedores", "odd_media_vencedor", True),
]
TEAM_CARD = [
    ("Jogos", "jogos", False),
    ("Posse de bola (média)", "posse_bola", True),
    ("xG médio", "xg_medio", True),
    ("xG total", "xg_total", True),
    ("Grandes chances criadas", "grandes_chances", False),
    ("Grandes chances por jogo", "grandes_chances_jogo", False),
    ("Grandes chances convertidas", "grandes_chances_convertidas", False),
    ("Aproveitamento das grandes chances", "aproveitamento_grandes_chances", True),
    ("Finalizações", "finalizacoes", False),
    ("Finalizações por jogo", "finalizacoes_jogo", True),
    ("Finalizações certas", "finalizacoes_certas", False),
    ("Finalizações certas por jogo", "finalizacoes_certas_jogo", True),
    ("% Acerto nas finalizações:", "acerto_finalizacoes", False),
    ("Finalizações dentro da área", "finalizacoes_area", False),
    ("Finalizações dentro da área por jogo", "finalizacoes_area_jogo", True),
    ("% de finalizações dentro da área", "perc_finalizacoes_area", True),
    ("Bolas na trave", "bolas_trave", False),
    ("Escanteios", "escanteios", False),
    ("Escanteios por jogo", "escanteios_jogo", True),
    ("Passes", "passes", False),
    ("Passes certos", "passes_certos", False),
    ("Assertividade nos passes", "assertividade_passes", True),
    ("Entradas no terço final", "entradas_terco_final", False),
    ("Entradas no terço final por jogo", "entradas_terco_final_jogo", True),
    ("Faltas sofridas no terço final", "faltas_terco_final", False),
    ("Perdas de bola", "perdas_bola", False),
    ("Perdas de bola por jogo", "perdas_bola_jogo", True),
    ("Duelos ganhos (média)", "duelos_ganhos", True),
    ("Cartões amarelos", "amarelos", False),
    ("Cartões vermelhos", "vermelhos", False),
]

# --- team metrics of the monthly "sum" leaderboards ---
MONTHLY_SUM_METRICS = [
    "total_shots", "shots_on_target", "shots_inside_box", "hit_woodwork", "big_chances",
    "big_chances_scored", "corner_kicks", "passes", "accurate_passes", "through_balls",
    "final_third_entries", "fouled_in_final_third", "dispossessed", "yellow_cards",
]

# --- competition names: source name -> display name ---
COMPETITION_NAMES = {
    "Brasileirão Betano": "Brasileiro",
    "Copa Betano do Brasil": "Copa do Brasil",
    "FIFA Club World Cup": "Copa do Mundo de Clubes",
    "Brasileiro Série B": "Brasileiro - Série B",
    "World Cup Qual. UEFA L": "Eliminatórias",
    "World Cup Qual. UEFA H": "Eliminatórias",
    "World Cup Qual. UEFA G": "Eliminatórias",
    "World Cup Qual. UEFA C": "Eliminatórias",
    "World Cup Qual. UEFA J": "Eliminatórias",
    "World Cup Qual. UEFA D": "Eliminatórias",
    "World Cup Qual. UEFA B": "Eliminatórias",
    "World Cup Qual. UEFA A": "Eliminatórias",
    "CONMEBOL Libertadores": "Libertadores",
    "CONMEBOL Sudamericana": "Sul-Americana",
    "Stars Cup": "Copa do Catar I",
    "World Cup Qualification": "Eliminatórias",
    "World Cup Qual. CONCACAF Gr. 2": "Eliminatórias",
    "World Cup Qual. CONCACAF Group A": "Eliminatórias",
    "World Cup Qual. CONCACAF Gr. 1": "Eliminatórias",
    "World Cup Qual. CONCACAF Gr. 3": "Eliminatórias",
    "World Cup Qual. UEFA K": "Eliminatórias",
    "Mineiro Módulo I": "Mineiro",
    "Paulista Série A1": "Paulista",
    "Carioca Série A – Taça Guanabara": "Carioca",
    "Gaúcho - Mata-mata": "Gaúcho",
    "Baiano, Série A": "Baiano",
    "Cearense, Série A": "Cearense",
    "CONMEBOL Recopa": "Recopa Sul-Americana",
    "Mineiro Módulo I - Troféu Inconfidência": "Mineiro",
    "Goiano, 1ª Divisão": "Goiano",
    "UEFA Europa League": "Liga Europa",
    "UEFA Champions League": "Liga dos Campeões",
    "UEFA Conference League": "Conference League",
    "UEFA Europa Conference League": "Conference League",
    "NM Cup": "Copa da Noruega",
    "Primera A": "Colombiano",
    "Svenska Cupen": "Copa da Suécia",
    "Liga de Primera": "Chileno",
    "Liga AUF Uruguaya": "Uruguaio",
    "J1 League": "Japonês",
    "Primera Division": "Venezuelano",
    "Copa Venezuela": "Copa da Venezuela",
    "División Profesional": "Boliviano",
    "Copa Division Profesional": "Copa da Bolívia",
    "Super Cup": "Supercopa",
    "Copa Colombia": "Copa da Colômbia",
    "Liga 1": "Peruano",
    "Premier Division": "Irlandês",
    "ÖFB Cup": "Copa da Áustria",
    "LigaPro Serie A": "Equatoriano",
    "Eliteserien": "Norueguês",
    "Copa Argentina": "Copa da Argentina",
    "World Cup Qual. CAF": "Eliminatórias",
    "World Cup Qual. UEFA I": "Eliminatórias",
    "World Cup Qual. UEFA F": "Eliminatórias",
    "World Cup Qual. CONCACAF Group C": "Eliminatórias",
    "World Cup Qual. CONCACAF Group B": "Eliminatórias",
    "Gaucho": "Gaúcho",
    "Stars League": "Catar",
    "Qatar Cup": "Catar Cup",
    "Allsvenskan": "Sueco",
    "Primera División": "Paraguaio",
    "Supercopa Internacional": "Supercopa da Argentina",
    "Liga Profesional de Fútbol": "Argentino",
    "Liga Profesional": "Argentino",
    "Copa Paraguay": "Copa do Paraguai",
    "Austrian Bundesliga": "Austríaco",
    "Campeonato Paraense": "Paraense",
    "Liga de Primera - Relegation Playoffs": "Chileno",
    "Copa Chile": "Copa do Chile",
    "Copa Ecuador": "Copa do Equador",
    "Supercopa": "Supercopa do Equador",
    "MLS Pre Season": "MLS Pré-Temporada",
    "Leinster Senior Cup": "Copa da Liga da Irlanda",
    "FAI Presidents Cup": "Supercopa da Irlanda",
    "Emperor Cup": "Copa do Imperador",
    "J. League Cup": "Copa da Liga do Japão",
    "FAI Cup": "Copa da Irlanda",
    "Mozzart Kup Srbije": "Copa da Sérvia",
    "División de Honor": "Paraguaio",
    "Supercopa Uruguaya": "Supercopa do Uruguai",
    "Baianão Mansão Green 2026": "Baiano",
    "Recopa Gaucha": "Recopa Gaúcha",
    "QSL Cup": "Copa do Catar I",
    "Supercopa Venezuela": "Supercopa da Venezuela",
    "Community Shield": "Supercopa da Inglaterra",
    "FA Cup": "Copa da Inglaterra",
    "EFL Cup": "Copa da Liga Inglesa",
    "Copa Bolivia": "Copa da Bolívia",
    "LaLiga": "La Liga",
    "Mineiro Módulo I - Classificação contra o rebaixamento": "Mineiro",
    "Carioca Série A – Mata-mata": "Carioca",
    "Carioca - Taça Rio": "Carioca",
    "Liga DIMAYOR": "Colombiano",
    "Africa Cup of Nations": "Copa das Nações Africanas",
    "World Cup Qual. UEFA E": "Eliminatórias",
    "Carioca - Semifinais": "Carioca",
    "Carioca - Classificação preliminar": "Carioca",
    "Carioca - Classificação contra o rebaixamento": "Carioca",
    "Carioca - Mata-mata contra o rebaixamento": "Carioca",
    "Carioca - Mata-mata da Taça Guanabara": "Carioca",
    "Gaúcho - Final": "Gaúcho",
    "Gaúcho 2ª fase": "Gaúcho",
    "Pernambucano - Luta contra o rebaixamento": "Pernambucano",
    "Cearense - Luta contra o rebaixamento": "Cearense",
    "Goiano - Grupo B": "Goiano",
    "Goiano - Grupo A": "Goiano",
    "Supercopa de España": "Supercopa da Espanha",
    "Copa del Rey": "Copa do Rei",
    "Coppa Italia": "Copa da Itália",
    "Supercoppa Italiana": "Supercopa da Itália",
    "DFL Supercup": "Supercopa da Alemanha",
    "Supercup": "Supercopa da Alemanha",
    "DFB Pokal": "Copa da Alemanha",
    "Trophée des Champions": "Supercopa da França",
    "Coupe de France": "Copa da França",
    "Copa Bicentenario": "Copa do Peru",
    "Supercopa Peruana": "Supercopa do Peru",
    "Liga Portugal Betclic": "Português",
    "Taça de Portugal": "Copa de Portugal",
    "League Cup": "Copa da Liga Portuguesa",
    "Johan Cruijff Schaal": "Supercopa da Holanda",
    "KNVB beker": "Copa da Holanda",
    "Ukraine Cup": "Copa da Ucrânia",
    "Trendyol Süper Lig": "Turco",
    "Super Kupa": "Supercopa da Turquia",
    "Turkiye Kupasi": "Copa da Turquia",
    "Stoiximan Super League": "Grego",
    "Greek Football Cup": "Copa da Grécia",
    "Saudi Pro League": "Saudita",
    "King's Cup": "Copa da Arábia",
    "UEFA Super Cup": "Supercopa da Europa",
    "Liga dos Campeões da UEFA": "Liga dos Campeões",
    "AFC Champions League Elite": "Liga dos Campeões da Ásia",
    "CONCACAF Champions Cup": "Copa dos Campeões da Concacaf",
    "Liga MX": "Mexicano",
    "Supercopa Liga MX": "Supercopa da Liga Mexicana",
    "Russian Cup": "Copa da Rússia",
    "Danish Superliga": "Dinamarquês",
    "Oddset Pokalen": "Copa da Dinamarca",
    "Pro League": "Belga",
    "Mozzart Bet Superliga": "Sérvio",
    "Beker van Belgie": "Copa da Bélgica",
    "Primera LPF": "Argentino",
    "World Cup Qualificação": "Eliminatórias",
    "Int. Friendly Games": "Amistoso",
    "CONMEBOL Copa América": "Copa América",
    "UEFA Nations League": "Nations League",
    "Euro": "Eurocopa",
    "FIFA World Cup": "Copa do Mundo",
    "Copa Uruguay": "Copa do Uruguai",
    "CONCACAF Gold Cup": "Copa Ouro",
    "FIFA Intercontinental Cup": "Mundial de Clubes",
    "VriendenLoterij Eredivisie": "Eredivisie",
    "Brasileirão Série B": "Brasileiro - Série B",
    "Greece Cup": "Copa da Grécia",
}
