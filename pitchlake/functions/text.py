"""Cleaning of text: percentages, fractions, dates, names, headers and links."""

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.functions import fixed

INTEGERS = ("int", "bigint", "long")


def percent(c: Column) -> Column:
    """'54%' or '54,3%' -> 54.0 / 54.3; NULL for anything that is not a number."""
    plain = F.trim(F.translate(c, ",%", "."))
    return plain.try_cast("decimal(9,3)").cast("double")


def won_of_total(c: Column) -> Column:
    """'5/16 (31%)' -> struct(certos, total, acerto); the share is recomputed."""
    won = F.regexp_extract(c, fixed.WON_OF_TOTAL, 1).try_cast("int")
    total = F.regexp_extract(c, fixed.WON_OF_TOTAL, 2).try_cast("int")
    share = F.round(
        F.try_divide(won.cast("decimal(18,0)") * 100, total.cast("decimal(18,0)")), 2
    ).cast("double")
    return F.struct(won.alias("certos"), total.alias("total"), share.alias("acerto"))


def number(c: Column, type_name: str = "double", default=None) -> Column:
    """Numeric coercion; a bad value becomes ``default`` (NULL unless given).

    Integers are cut from decimals, since tools that know no missing integer write 2 as '2.0'.
    """
    value = blank_to_null(F.trim(c.cast("string")))
    if type_name in INTEGERS:
        value = value.try_cast("decimal(38,10)")
    value = value.try_cast(type_name)
    return value if default is None else F.coalesce(value, F.lit(default).cast(type_name))


def blank_to_null(c: Column) -> Column:
    """'', 'nan' and 'NaN' (as text) -> NULL."""
    return F.when(~c.isin(*fixed.NULL_TEXTS), c)


def finite(c: Column) -> Column:
    """NaN and +-infinity -> NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def parse_date(c: Column) -> Column:
    """DATE from yyyy-MM-dd..., dd/MM/yyyy..., d-M-yyyy or yyyy/M/d text, else NULL."""
    clean = F.trim(F.translate(c, "\u00a0\t\r\n", ""))
    iso = F.when(clean.rlike(r"^.{4}-.{2}-.{2}"), F.substring(clean, 1, 10))
    slash = F.when(
        clean.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"), F.substring_index(clean, " ", 1)
    )
    dash = F.when(clean.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), clean)
    year = F.when(clean.rlike(r"^[0-9]{4}[/-][0-9]{1,2}[/-][0-9]{1,2}( |$)"),
                  F.translate(F.substring_index(clean, " ", 1), "-", "/"))
    return F.coalesce(
        F.try_to_date(iso, "yyyy-MM-dd"),
        F.try_to_date(slash, "d/M/yyyy"),
        F.try_to_date(dash, "d-M-yyyy"),
        F.try_to_date(year, "yyyy/M/d"),
    )


def parse_loaded_at(c: Column, default: Column | None = None) -> Column:
    """Load time from dd/MM/yyyy HH:mm or ISO text, else ``default`` (the load time)."""
    parsed = F.coalesce(
        F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd")),
    )
    return F.coalesce(parsed, F.current_timestamp() if default is None else default)


def local_date(epoch: Column) -> Column:
    """Match date at UTC-3 from epoch seconds; independent of the session time zone."""
    return F.date_add(
        F.lit("1970-01-01").cast("date"),
        F.floor((epoch + F.lit(fixed.LOCAL_OFFSET_SECONDS)) / 86400).cast("int"),
    )


def local_time(epoch: Column) -> Column:
    """Kick-off 'HH:mm' at UTC-3 from epoch seconds."""
    minute = F.pmod(
        F.floor((epoch + F.lit(fixed.LOCAL_OFFSET_SECONDS)) / 60).cast("bigint"), F.lit(1440)
    )
    return F.format_string("%02d:%02d", F.floor(minute / 60), minute % 60)


def competition_key(c: Column) -> Column:
    """Source competition name up to the first comma, trimmed; '' for NULL."""
    return F.trim(F.split(F.coalesce(c, F.lit("")), ",", 2)[0])


def round_number(name: Column, number_: Column) -> Column:
    """First digits of the round name (or of the round number), else '0'."""
    source = F.coalesce(
        F.nullif(name, F.lit("")), F.nullif(number_.cast("string"), F.lit("0")), F.lit("0")
    )
    return F.coalesce(F.nullif(F.regexp_extract(source, r"\d+", 0), F.lit("")), F.lit("0"))


def metric_column(label: Column) -> Column:
    """'Shots (on target)' -> 'shots_on_target'."""
    return F.translate(F.lower(label), " ()", "_")


def snake_case(key: Column) -> Column:
    """'bigChanceCreated' -> 'big_chance_created'."""
    small = F.lower(key)
    return F.when(key == small, key).otherwise(F.lower(F.regexp_replace(key, "(?<!^)(?=[A-Z])", "_")))


@functools.cache
def _accents() -> tuple[str, str]:
    """Letters of the Latin blocks that decompose into a plain letter and marks, and these letters.

    The combining marks come last and have no counterpart, so ``translate`` deletes them.
    """
    pairs = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            pairs[chr(code)] = base
    marks = "".join(map(chr, range(0x300, 0x370)))
    return "".join(pairs) + marks, "".join(pairs.values())


def strip_accents(c: Column) -> Column:
    """Letters without their marks, composed or written with combining ones."""
    ascii_only = F.length(c) == F.octet_length(c)
    return F.when(ascii_only, c).otherwise(F.translate(c, *_accents()))


def header_token(c: Column) -> Column:
    """Header cell as a comparable token: no BOM, lower case, no accents, '_' between words."""
    plain = strip_accents(F.lower(F.trim(F.translate(c, "\ufeff", ""))))
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def plain_text(c: Column) -> Column:
    """Lower-case ASCII form of a label, for banned-word tests."""
    return F.trim(F.lower(F.regexp_replace(strip_accents(c), r"[^\x00-\x7F]", "")))


def clean_link(line: Column) -> Column:
    """One line of a link list -> URL; NULL for comments, blanks and non-http lines."""
    body = F.trim(F.regexp_replace(F.trim(line), r",$", ""))
    quoted = F.trim(F.regexp_replace(body, r"""^['"]|['"]$""", ""))
    keep = ~F.trim(line).startswith("#") & quoted.rlike(fixed.HTTP_WITH_HOST)
    return F.when(keep, quoted)


def link_match_id(link: Column) -> Column:
    """Match id of the '#id:<digits>' fragment, NULL without one."""
    return F.regexp_extract(link, fixed.LINK_MATCH_ID, 1).try_cast("bigint")
