"""Column expressions shared by every layer. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake import config as C

# ---- time --------------------------------------------------------------------


def peak_hour(ts: Column) -> Column:
    return F.hour(ts).isin(C.PEAK_HOURS)


def weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def working_day(ts: Column) -> Column:
    return ~weekend(ts)


def hour_key(ts: Column) -> Column:
    """YYYYMMDDHH as a long, by arithmetic rather than formatting."""
    return (
        F.year(ts).cast("long") * 1_000_000 + F.month(ts) * 10_000 + F.dayofmonth(ts) * 100 + F.hour(ts)
    ).cast("long")


def hour_start(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts).cast("timestamp_ntz")


def local_from_utc(ts: Column, hours: int = C.UTC_OFFSET_HOURS) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def parse_ts(text: Column, pattern: str) -> Column:
    """Wall-clock text to a zone-less timestamp; unreadable text gives null."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", F.date_trunc("SECOND", start).cast("timestamp_ntz"), end)


def midnight(day) -> Column:
    return F.lit(day).cast("date").cast("timestamp_ntz")


# ---- money -------------------------------------------------------------------


def cents(amount: Column) -> Column:
    """Whole cents, halves away from zero. Integer sums do not depend on the order of partial sums.

    Written with a cast and comparisons because ``round`` on doubles goes through decimal objects,
    which is felt when every raw event passes here.
    """
    scaled = amount * 100
    whole = scaled.cast("long")
    return whole + F.when(scaled - whole >= 0.5, 1).when(scaled - whole <= -0.5, -1).otherwise(0)


def from_cents(total: Column) -> Column:
    return total / F.lit(100.0)


# ---- cards and identity --------------------------------------------------------


def card_operator(card: Column) -> Column:
    """Which operator's key format a card has; first match wins."""
    return (
        F.when(card.startswith("TC-"), C.TRANSMETRO)
        .when(card.startswith("MR"), C.METRORIEL)
        .when(card.rlike("^[0-9]{10}$"), C.TRANSURBANO)
        .when(card == "SIN-TARJETA", "SIN_TARJETA")
        .otherwise("DESCONOCIDO")
    )


def card_number(card: Column) -> Column:
    """First run of digits as a number; null when there is none."""
    return F.regexp_extract(card, "[0-9]+", 0).try_cast("long")


def pseudonym(salt: str, scope: Column, key: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.lit(salt), F.lit(":"), scope, F.lit(":"), key), 256), 1, 16)


def person_key(salt: str, operator: Column, card: Column) -> Column:
    """One key for the same card number across linked operators, else the card's own pseudonym."""
    linked = pseudonym(salt, F.lit("PERSONA"), card_number(card).cast("string"))
    return F.when(operator.isin(C.LINKED_OPERATORS), linked).otherwise(pseudonym(salt, operator, card))


def unit_id(operator: Column, card: Column) -> Column:
    return F.when(
        operator.isin(C.LINKED_OPERATORS), F.concat(F.lit("P"), card_number(card).cast("string"))
    ).otherwise(F.concat(F.lit("A"), card))


# ---- labels and names ------------------------------------------------------------


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def status_label(code: Column) -> Column:
    return (
        F.when(code.isin(C.STATUS_OK_CODES), "OK")
        .when(code == C.STATUS_NO_BALANCE, "SALDO_INSUF")
        .when(code == C.STATUS_BAD_CARD, "TARJETA_INVALIDA")
        .otherwise("DESCONOCIDO")
    )


def title_case(text: Column) -> Column:
    return F.initcap(F.lower(text))


def canonical_zone(sector: Column) -> Column:
    """``Z10`` becomes ``Zona 10``; a municipality in capitals becomes title case."""
    return F.when(
        sector.rlike("^Z[0-9]+$"), F.concat(F.lit("Zona "), F.regexp_extract(sector, "[0-9]+", 0))
    ).otherwise(title_case(sector))


def zone_kind(zone: Column) -> Column:
    return F.when(zone.startswith("Zona "), "ZONA_GUATEMALA").otherwise("MUNICIPIO")


def share(part: Column, whole: Column) -> Column:
    """Proportion of two exact counts."""
    return part.cast("double") / whole
