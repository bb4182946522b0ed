"""Money and quantity texts. Money is decimal, never double."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import blank_to_null, strip
from orderloom.rules import DASH

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,3)"


def parse_money_br(c: Column) -> Column:
    """``1.234,56`` (pt-BR); unparsable is null. ``1,234.56`` reads as 1.23."""
    plain = F.replace(F.translate(c, "$.", ""), F.lit(","), F.lit("."))
    return strip(plain).try_cast(MONEY)


def parse_money_us(c: Column, on_error: str = "null") -> Column:
    """``$1,234.56``; unparsable is null, zero, or an error, as asked."""
    plain = strip(F.translate(c, "$,", ""))
    if on_error == "fail":
        return plain.cast(MONEY)
    parsed = plain.try_cast(MONEY)
    if on_error == "zero":
        return F.coalesce(parsed, F.lit(0).cast(MONEY))
    if on_error == "null":
        return parsed
    raise ValueError(f"on_error must be null, zero or fail, not {on_error!r}")


def to_number_or_zero(c: Column, kind: str = QUANTITY) -> Column:
    return F.coalesce(strip(c.cast("string")).try_cast(kind), F.lit(0).cast(kind))


def to_cents(c: Column) -> Column:
    return (c * 100).cast("bigint")


def fixed2(c: Column) -> Column:
    return c.cast(MONEY).cast("string")


def quantity_text(c: Column) -> Column:
    """Number without trailing zeros: ``5``, ``0``, ``2.5``."""
    return F.regexp_replace(c.cast(QUANTITY).cast("string"), r"\.?0+$", "")


def format_brl(c: Column) -> Column:
    """pt-BR currency text, with the no-break space browsers put after ``R$``."""
    amount = F.coalesce(c, F.lit(0).cast(MONEY))
    digits = F.translate(F.format_number(F.abs(amount), 2), ",.", ".,")
    return F.concat(F.when(amount < 0, F.lit("-")).otherwise(F.lit("")),
                    F.lit("R$\u00a0"), digits)


def format_total(c: Column) -> Column:
    amount = parse_money_br(c)
    return (F.when(blank_to_null(c).isNull(), F.lit(DASH))
            .when(amount.isNull(), c)
            .otherwise(format_brl(amount)))


def unit_price(total: Column, quantity: Column, price_is: str = "line") -> Column:
    """Price of one unit, two decimals; null where the quantity is zero.

    ``price_is="unit"`` takes the captured price as the unit price already.
    """
    if price_is == "unit":
        return F.when(quantity != 0, total.cast(MONEY))
    if price_is != "line":
        raise ValueError(f"price_is must be line or unit, not {price_is!r}")
    return F.when(quantity != 0, (total / F.nullif(quantity, F.lit(0))).cast(MONEY))


