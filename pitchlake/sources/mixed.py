"""Historic results in files of different layouts, read together: a header per file, or none.

All files are read as lines with the name of their file. One aggregate finds each file's header, the
first of its lines that has a known header word and no run of four digits, as every data
line has in its season or date. Layouts (distinct headers) are few and are mapped to the contract
once; each line is then taken apart by the separator and the columns of its own file. A
line that cannot be used stays in the result with the reason, so good rows and rejects come
from the same pass.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions import fixed, text
from pitchlake.session import materialise
from pitchlake.sources import files

COLUMNS = fixed.HISTORY_COLUMNS
FILE, LINE, REASON = "arquivo", "linha", "motivo"
_KNOWN = sorted({s for synonyms in fixed.HISTORY_HEADER_SYNONYMS.values() for s in synonyms})


def lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(arquivo, linha, ordem) of every line that is not empty; ordem rises within a file."""
    return spark.read.schema(f"{LINE} STRING").option("sep", "\u0001").option("quote", "").option("encoding", encoding).csv(path).select(
        F.col("_metadata.file_path").alias(FILE), F.translate(LINE, "\ufeff", "").alias(LINE),
        F.struct(F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i")).alias("ordem"),
    ).filter(F.col(LINE).isNotNull() & (F.trim(LINE) != ""))


def _separator(line: Column) -> Column:
    """The candidate that occurs most often; the first of equal ones, and a comma where there is none."""
    counts = [F.struct((F.length(line) - F.length(F.replace(line, F.lit(s)))).alias("n"), F.lit(-i).alias("o"), F.lit(s).alias("s"))
              for i, s in enumerate(fixed.SEPARATORS)]
    most = F.greatest(*counts)
    return F.when(most["n"] > 0, most["s"]).otherwise(",")


def _split(line: Column, sep: Column, width: int) -> Column:
    """Cells of a line, quotes respected; missing ones are NULL, one after ``width`` is surplus."""
    schema = ", ".join(f"c{i} STRING" for i in range(width + 1))
    parsed = F.coalesce(*[
        F.when(sep == s, F.from_csv(line, schema, {"sep": s, "nullValue": "\u0001", "emptyValue": ""})) for s in fixed.SEPARATORS])
    return F.array(*[parsed[f"c{i}"] for i in range(width + 1)])


def headers(all_lines: DataFrame) -> DataFrame:
    """(arquivo, cabecalho): the header of each file that has one."""
    could = all_lines.filter(~F.col(LINE).rlike("[0-9]{4}"))
    tokens = F.transform(F.split(LINE, "[;,\t|]"), lambda c: text.header_token(F.translate(c, "\"'", "")))
    found = could.filter(F.exists(tokens, lambda t: t.isin(_KNOWN)))
    return found.groupBy(FILE).agg(F.min_by(LINE, "ordem").alias("cabecalho"))


def _layouts(spark: SparkSession, found: DataFrame) -> tuple[DataFrame, int]:
    """(cabecalho, sep, places, n) of each distinct header, and the most cells of any.

    A header that lacks a column of the contract gives no places: its lines are rejects.
    """
    rows = []
    for r in found.select("cabecalho").distinct().collect():  # a row for each layout
        sep = files.choose_separator(r["cabecalho"])
        cells = [c.strip().strip("\"'") for c in r["cabecalho"].split(sep)]
        tokens = files.header_tokens(spark, cells)
        place = {column: tokens.index(t) for t, column in files.match_history_header(tokens).items()}
        whole = all(c in place for c in COLUMNS)
        rows.append((r["cabecalho"], sep, [place[c] for c in COLUMNS] if whole else None, len(cells)))
    width = max([len(COLUMNS), *[n for *_, n in rows]])
    return spark.createDataFrame(rows, "cabecalho STRING, sep STRING, places ARRAY<INT>, n INT"), width


def read_mixed_history(
    spark: SparkSession, path: str, encoding: str = "UTF-8", loaded_at: Column | None = None,
    widths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Historic results of all files under ``path`` with ``arquivo``, ``linha`` and ``motivo``.

    ``motivo`` is NULL for a row that can be used, else 'cabecalho' (the file's header lacks a
    column), 'campos' (surplus fields, or fewer than the file's date column) or 'data' (no valid
    date); such rows keep their line. Files without a header have the contract's order. Headers
    that come again in a file are no rows. Missing goals count as 0.
    """
    every = lines(spark, path, encoding)
    found = materialise(headers(every), "headers")
    layouts, width = _layouts(spark, found)
    of_file = materialise(found.join(layouts, "cabecalho"), "layouts")
    joined = every.join(of_file, FILE, "left").filter(F.col("cabecalho").isNull() | (F.col(LINE) != F.col("cabecalho")))
    own = joined.withColumns({
        "sep": F.coalesce("sep", _separator(F.col(LINE))),
        "n": F.coalesce("n", F.lit(len(COLUMNS))),
        "places": F.when(F.col("cabecalho").isNull(), F.array(*[F.lit(i) for i in range(len(COLUMNS))])).otherwise(F.col("places")),
    })
    cells = own.withColumn("c", _split(F.col(LINE), F.col("sep"), width))
    raw = cells.select(FILE, LINE, "places", F.get("c", F.col("n")).isNotNull().alias("surplus"), *[
        F.get("c", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(COLUMNS)])
    date = text.parse_date(F.col("data"))
    reason = (F.when(F.col("places").isNull(), "cabecalho").when(F.col("surplus") | F.col("data").isNull(), "campos").when(date.isNull(), "data"))
    clean = lambda c: files.text.blank_to_null(F.trim(c))
    values = {
        "data": date, "gols_casa": text.number(F.col("gols_casa"), "int", 0), "gols_fora": text.number(F.col("gols_fora"), "int", 0)}
    out = raw.withColumn(REASON, reason).select(FILE, LINE, REASON, *[
        F.when(F.col(REASON).isNull(), values.get(c, clean(F.col(c)))).alias(c) for c in COLUMNS])
    out = out.withColumns({c: F.substring(c, 1, n) for c, n in (widths or {}).items()})
    return out.withColumn("cadastrado_em", F.current_timestamp() if loaded_at is None else loaded_at)
