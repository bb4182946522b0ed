"""Fields out of invoice texts and captured label arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import digits_only, strip
from orderloom.rules import (EXEMPT, KEY_DIGITS, KEY_RUN_PATTERN, NOT_FOUND_F, NOT_FOUND_M,
                             STATE_REG_PREFIX, TAX_ID_PATTERN, TOTAL_PATTERN)


def ocr_fix(c: Column) -> Column:
    """Undo usual OCR confusions: letters O and I for digits, stray bars."""
    return F.translate(c, "OoI|", "001")


def tax_ids(c: Column) -> Column:
    """All company numbers in a raw invoice text."""
    return F.regexp_extract_all(ocr_fix(c), F.lit(TAX_ID_PATTERN), F.lit(1))


def first_tax_id(c: Column) -> Column:
    return F.coalesce(F.get(tax_ids(c), F.lit(0)), F.lit(NOT_FOUND_M))


def totals(c: Column) -> Column:
    """Amounts after the total labels. Read from the text *before* the OCR fix,
    which would turn the letter O of the labels into a digit."""
    return F.regexp_extract_all(c, F.lit(TOTAL_PATTERN), F.lit(1))


def last_total(c: Column) -> Column:
    return F.coalesce(F.try_element_at(totals(c), F.lit(-1)), F.lit(NOT_FOUND_M))


def access_keys(c: Column) -> Column:
    """Digit runs (blanks allowed) that hold exactly one access key."""
    runs = F.regexp_extract_all(ocr_fix(c), F.lit(KEY_RUN_PATTERN), F.lit(1))
    return F.filter(F.transform(runs, digits_only), lambda k: F.length(k) == KEY_DIGITS)


def first_access_key(c: Column) -> Column:
    return F.coalesce(F.get(access_keys(c), F.lit(0)), F.lit(NOT_FOUND_F))


def label_values(texts: Column) -> Column:
    """Texts of a label block without the label itself (its first element)."""
    return F.coalesce(F.slice(texts, 2, F.greatest(F.size(texts) - 1, F.lit(0))),
                      F.array().cast("array<string>"))


def document_of(values: Column) -> Column:
    """First text naming a personal or company document, trimmed; else null."""
    hits = F.filter(values, lambda s: F.contains(s, F.lit("CPF")) | F.contains(s, F.lit("CNPJ")))
    return strip(F.get(hits, F.lit(0)))


def state_registration_of(values: Column) -> Column:
    hits = F.filter(values, lambda s: F.contains(s, F.lit("INSCRICAO")))
    plain = strip(F.replace(F.get(hits, F.lit(0)), F.lit(STATE_REG_PREFIX), F.lit("")))
    return F.coalesce(plain, F.lit(EXEMPT))
