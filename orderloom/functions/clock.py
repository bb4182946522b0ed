"""Predicates and texts of a timestamp; "now" is always a parameter."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import blank_to_null
from orderloom.rules import AFTERNOON, MORNING, NIGHT


def day_greeting(ts: Column, name: Column | None = None) -> Column:
    """Greeting of the hour, followed by ``, name`` where a name is given."""
    hour = F.hour(ts)
    base = (F.when((hour >= 5) & (hour < 12), F.lit(MORNING))
            .when((hour >= 12) & (hour < 18), F.lit(AFTERNOON))
            .otherwise(F.lit(NIGHT)))
    if name is None:
        return base
    return F.concat_ws(", ", base, blank_to_null(name))


def business_hours(ts: Column) -> Column:
    """Monday to Friday, 09:00 up to but not including 18:00."""
    return (F.weekday(ts) < 5) & F.hour(ts).between(9, 17)


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")
