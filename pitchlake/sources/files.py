"""CSV and text sources: match backup, goals, historic results, odds, link lists."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake import schemas
from pitchlake.functions import fixed, text

BAD = "_linha"


def _cells(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """Cells of the first line as Spark's CSV reader splits it, in the file's encoding."""
    row = spark.read.option("sep", sep).option("encoding", encoding).csv(path).limit(1).head()
    return [c or "" for c in row] if row else []


def _first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    cells = _cells(spark, path, "\u0001", encoding)
    return cells[0] if cells else ""


def choose_separator(header: str, default: str = ",") -> str:
    """The candidate that occurs most often in the header line."""
    most = max(fixed.SEPARATORS, key=header.count)
    return most if header.count(most) else default


def header_tokens(spark: SparkSession, cells: Sequence[str]) -> list[str]:
    """Normalised header cells."""
    if not cells:
        return []
    row = spark.range(1).select(F.array(*[text.header_token(F.lit(c)) for c in cells]).alias("t")).head()
    return list(row["t"])


def _strings(
    spark: SparkSession, path: str, names: Sequence[str], sep: str, header: Sequence[str] | None,
    encoding: str,
) -> DataFrame:
    """All-text read under given names, and in ``_linha`` each line with more fields than names.

    ``header`` has the raw header cells: every file must begin with the same ones, or the read
    fails. A shorter line is padded with NULL.
    """
    raw = [f"c{i}" for i in range(len(names))] if header is None else list(header)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*raw, BAD]])
    df = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header is not None)
        .option("enforceSchema", header is None)
        .option("columnNameOfCorruptRecord", BAD)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("nullValue", "\u0001")
        .option("emptyValue", "")
        .csv(path)
    ).toDF(*[f"c{i}" for i in range(len(raw))], BAD)
    # A line of another length is in BAD; only one that is too long has a last cell, be it empty.
    surplus = F.when(F.col(BAD).isNotNull() & F.col(f"c{len(raw) - 1}").isNotNull(), F.col(BAD))
    cells = [text.blank_to_null(F.trim(F.col(f"c{i}"))).alias(n) for i, n in enumerate(names)]
    return df.select(*cells, surplus.alias(BAD))


def _whole(df: DataFrame) -> DataFrame:
    """Fail on a line with surplus fields."""
    fail = F.raise_error(F.concat(F.lit("line with surplus fields: "), F.col(BAD))).cast("boolean")
    return df.filter(F.when(F.col(BAD).isNull(), F.lit(True)).otherwise(fail)).drop(BAD)


def require_columns(found: Sequence[str], needed: Sequence[str]) -> None:
    missing = [c for c in needed if c not in found]
    if missing:
        raise ValueError(f"missing columns {missing}; found {list(found)}")


def _typed(df: DataFrame, schema, special: dict[str, Column]) -> DataFrame:
    cols = []
    for f in schema.fields:
        value = special.get(f.name)
        if value is None:
            kind = f.dataType.simpleString()
            value = F.lit(None) if f.name not in df.columns else (
                text.number(F.col(f.name), kind) if kind in text.INTEGERS else F.col(f.name).try_cast(f.dataType))
        cols.append(value.cast(f.dataType).alias(f.name))
    return df.select(cols)


def read_matches_csv(spark: SparkSession, path: str, loaded_at: Column | None = None) -> DataFrame:
    """Semicolon match backup -> the matches contract; a line with surplus fields fails."""
    cells = _cells(spark, path, ";", "UTF-8")
    names = header_tokens(spark, cells)
    require_columns(names, fixed.MATCH_BACKUP_COLUMNS)
    df = _whole(_strings(spark, path, names, ";", cells, "UTF-8")).select(fixed.MATCH_BACKUP_COLUMNS)
    return _typed(
        df,
        schemas.MATCHES,
        {
            "data": text.parse_date(F.col("data")),
            "cadastrado_em": text.parse_loaded_at(F.col("cadastrado_em"), loaded_at),
        },
    )


def read_goals_csv(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str = "UTF-8",
    loaded_at: Column | None = None,
) -> DataFrame:
    """Goals file; the separator comes from the header unless given. Surplus fields fail."""
    sep = sep or choose_separator(_first_line(spark, path, encoding), ";")
    cells = _cells(spark, path, sep, encoding)
    names = header_tokens(spark, cells)
    require_columns(names, fixed.GOAL_COLUMNS)
    df = _whole(_strings(spark, path, names, sep, cells, encoding))
    when = F.col("cadastrado_em") if "cadastrado_em" in names else F.lit(None).cast("string")
    return _typed(df, schemas.GOALS, {"cadastrado_em": text.parse_loaded_at(when, loaded_at)})


def match_history_header(tokens: Sequence[str]) -> dict[str, str]:
    """Header token -> contract column, by synonym first and by main word second."""
    free, found = list(tokens), {}
    for column, synonyms in fixed.HISTORY_HEADER_SYNONYMS.items():
        word = column.partition("_")[0]
        exact = [t for t in free if t in synonyms]
        loose = [t for t in free if word in t]
        if exact or loose:
            token = (exact or loose)[0]
            free.remove(token)
            found[token] = column
    return found


def _history_strings(spark: SparkSession, path: str, sep: str | None, encoding: str) -> DataFrame:
    sep = sep or choose_separator(_first_line(spark, path, encoding))
    cells = _cells(spark, path, sep, encoding)
    tokens = header_tokens(spark, cells)
    mapping = match_history_header(tokens)
    known = {s for synonyms in fixed.HISTORY_HEADER_SYNONYMS.values() for s in synonyms}
    has_header = any(t in known for t in tokens)
    if has_header:
        first = {t: i for i, t in reversed(list(enumerate(tokens)))}
        names = [mapping[t] if t in mapping and first[t] == i else f"_c{i}" for i, t in enumerate(tokens)]
        require_columns(names, fixed.HISTORY_COLUMNS)
    else:
        names = fixed.HISTORY_COLUMNS
        if len(tokens) < len(names):
            raise ValueError(f"no header and {len(tokens)} columns instead of {len(names)}")
    return _strings(spark, path, names, sep, cells if has_header else None, encoding)


def read_history_csv(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str = "UTF-8",
    loaded_at: Column | None = None,
    widths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Historic results with a header in any known wording, or with none.

    A first line with at least one known header word is a header. Missing goals count as 0.
    ``history_rejects`` has the lines that are left out: those with surplus fields or without a
    valid date. ``widths`` cuts text columns to the widths of a store that needs it.
    """
    df = _history_strings(spark, path, sep, encoding).filter(F.col(BAD).isNull()).drop(BAD)
    return normalise_history(df, loaded_at, widths)


def history_rejects(
    spark: SparkSession, path: str, sep: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """(motivo, linha) of the lines that ``read_history_csv`` leaves out."""
    df = _history_strings(spark, path, sep, encoding)
    line = F.coalesce(F.col(BAD), F.to_csv(F.struct(*fixed.HISTORY_COLUMNS)))
    reason = F.when(F.col(BAD).isNotNull(), "campos").when(text.parse_date(F.col("data")).isNull(), "data")
    return df.select(reason.alias("motivo"), line.alias("linha")).filter(F.col("motivo").isNotNull())


def normalise_history(
    df: DataFrame, loaded_at: Column | None = None, widths: Mapping[str, int] | None = None
) -> DataFrame:
    special = {
        "data": text.parse_date(F.col("data")),
        "gols_casa": text.number(F.col("gols_casa"), "int", 0),
        "gols_fora": text.number(F.col("gols_fora"), "int", 0),
        "cadastrado_em": F.current_timestamp() if loaded_at is None else loaded_at,
    }
    special |= {c: F.substring(c, 1, n) for c, n in (widths or {}).items()}
    return _typed(df, schemas.HISTORY, special).dropna(subset=["data"])


def read_odds_csv(spark: SparkSession, path: str) -> DataFrame:
    """Odds list where '-' means a missing value; a line with surplus fields fails."""
    df = _whole(_strings(spark, path, fixed.ODDS_COLUMNS, ",", _cells(spark, path, ",", "UTF-8"), "UTF-8"))

    def value(c: str, kind: str) -> Column:
        cell = F.nullif(F.col(c), F.lit("-"))
        return text.number(cell, kind) if kind in text.INTEGERS else cell.try_cast(kind)

    return df.select(
        F.col("Mandante").alias("casa"),
        F.col("Visitante").alias("fora"),
        value("Gol_Mandante", "int").alias("gols_casa"),
        value("Gol_Visitante", "int").alias("gols_fora"),
        value("Odd_1", "decimal(8,2)").alias("odd_casa"),
        value("Odd_X", "decimal(8,2)").alias("odd_empate"),
        value("Odd_2", "decimal(8,2)").alias("odd_fora"),
    )


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """Link list -> (posicao, link, id_jogo); comments, blanks and other schemes are skipped."""
    lines = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("posicao"), text.clean_link(F.col("value")).alias("link")
    )
    return lines.filter(F.col("link").isNotNull()).withColumn(
        "id_jogo", text.link_match_id(F.col("link"))
    )


def match_links(links: DataFrame) -> DataFrame:
    """Only the links that carry a match id."""
    return links.withColumn("id_jogo", text.link_match_id(F.col("link"))).filter(
        F.col("id_jogo").isNotNull()
    )


def filter_links(
    links: DataFrame,
    domain: str | None = None,
    exclude_prefixes: Sequence[str] = (),
    include_internal: bool = False,
    label: str | None = None,
) -> DataFrame:
    """Keep links of a domain, outside excluded prefixes and internal schemes, whose label
    has no banned word; of equal links the first seen stays. Needs (posicao, link)."""
    link = F.col("link")
    keep = link.isNotNull() & (F.trim(link) != "")
    if not include_internal:
        for scheme in fixed.INTERNAL_SCHEMES:
            keep = keep & ~link.startswith(scheme)
    if domain:
        keep = keep & F.lower(link).contains(domain.lower())
    for prefix in exclude_prefixes:
        keep = keep & ~link.startswith(prefix)
    if label is not None:
        words = "|".join(fixed.BANNED_LINK_WORDS)
        keep = keep & ~F.coalesce(text.plain_text(F.col(label)).rlike(words), F.lit(False))
    return links.filter(keep).groupBy("link").agg(F.min("posicao").alias("posicao"))
