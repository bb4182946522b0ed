"""Text cleaning and display of single columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.rules import DASH

WHITESPACE = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    """Trim blanks, tabs and line ends (plain ``trim`` takes blanks only)."""
    return F.trim(c, F.lit(WHITESPACE))


def remove(c: Column, token: str) -> Column:
    """Delete every occurrence of a literal token."""
    return F.replace(c, F.lit(token), F.lit(""))


def remove_first(c: Column, token: str) -> Column:
    """Delete the first occurrence of a literal token."""
    at = F.locate(token, c)
    rest = F.substring(c, at + F.lit(len(token)), F.length(c))
    return F.when(at > 0, F.concat(F.substring(c, F.lit(1), at - 1), rest)).otherwise(c)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def clean_tax_punct(c: Column) -> Column:
    """Drop only the punctuation of a tax number; letters survive."""
    return F.upper(strip(F.translate(c, "./-", "")))


def valid_tax_number(c: Column) -> Column:
    """A company number: ASCII digits, longer than a personal number."""
    return F.coalesce(c.rlike("^[0-9]+$") & (F.length(c) > 11), F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*cs: Column) -> Column:
    """First value that is neither null nor blank; the last one as it is."""
    return F.coalesce(*[blank_to_null(c) for c in cs[:-1]], cs[-1])


def key_text(c: Column) -> Column:
    """Keys are compared as trimmed text."""
    return strip(c.cast("string"))


def stored_text(c: Column) -> Column:
    """Text as the item table stores it: null becomes blank."""
    return F.coalesce(c.cast("string"), F.lit(""))


def bool_text(c: Column) -> Column:
    return F.when(c, F.lit("True")).when(~c, F.lit("False"))


def doc_type(c: Column) -> Column:
    """Text before the first colon."""
    return F.substring_index(c, ":", 1)


def doc_number(c: Column) -> Column:
    """Trimmed text between the first and second colon; null without colon."""
    second = F.substring_index(F.substring_index(c, ":", 2), ":", -1)
    return F.when(F.contains(c, F.lit(":")), strip(second))


def is_personal_document(c: Column) -> Column:
    return F.coalesce(F.contains(c, F.lit("CPF")), F.lit(False))


def clean_phone(c: Column) -> Column:
    return strip(F.translate(remove(remove(c, ".0"), "+55"), "()-", ""))


def upper_trim_city(c: Column) -> Column:
    return F.upper(strip(c))


def null_to_dash(c: Column) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(DASH))


def format_document(c: Column) -> Column:
    shown = remove_first(remove_first(c, "CNPJ: "), "CPF: ")
    return F.when(blank_to_null(c).isNull(), F.lit(DASH)).otherwise(shown)


def format_date_br(c: Column) -> Column:
    """``YYYY-MM-DD[ time]`` as ``DD/MM/YYYY``; a text with slashes loses only its
    time; anything else stays."""
    day = F.get(F.split(c, " "), F.lit(0))
    dashed, slashed = F.split(day, "-"), F.split(day, "/")
    third = blank_to_null(F.get(dashed, F.lit(2)))
    turned = F.concat_ws("/", third, F.get(dashed, F.lit(1)), F.get(dashed, F.lit(0)))
    return (F.when(blank_to_null(c).isNull(), F.lit(DASH))
            .when(third.isNotNull(), turned)
            .when(F.size(slashed) == 3, day)
            .otherwise(c))
