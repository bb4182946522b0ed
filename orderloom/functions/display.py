"""Dashboard families and badge colours, by substring of the lower-case text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import blank_to_null
from orderloom.rules import DASH


def _has(c: Column, *words: str) -> Column:
    low = F.lower(c)
    hit = F.contains(low, F.lit(words[0]))
    for word in words[1:]:
        hit = hit | F.contains(low, F.lit(word))
    return hit


def payment_family(c: Column) -> Column:
    return (F.when(blank_to_null(c).isNull(), F.lit(DASH))
            .when(_has(c, "pix"), F.lit("PIX"))
            .when(_has(c, "dinheiro"), F.lit("Dinheiro"))
            .when(_has(c, "cartão", "cartao"), F.lit("Cartão"))
            .when(_has(c, "boleto"), F.lit("Boleto"))
            .otherwise(F.get(F.split(c, " "), F.lit(0))))


def payment_badge(c: Column) -> Column:
    return (F.when(_has(c, "pix"), F.lit("badge-green"))
            .when(_has(c, "dinheiro"), F.lit("badge-blue"))
            .when(_has(c, "cartão", "cartao"), F.lit("badge-yellow"))
            .otherwise(F.lit("badge-gray")))


def status_badge(c: Column) -> Column:
    return (F.when(blank_to_null(c).isNull(), F.lit("badge-gray"))
            .when(_has(c, "preparado", "entregue"), F.lit("badge-green"))
            .when(_has(c, "cancelad", "recusad"), F.lit("badge-red"))
            .otherwise(F.lit("badge-yellow")))
