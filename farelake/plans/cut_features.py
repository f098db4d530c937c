"""Population, features and label at one or several cut dates.

For a cut ``t`` (midnight): features from events in ``[t - window, t)``, label 1 when no event falls
in ``[t, t + horizon)``, population = enough trips in the window and not deleted from the registry
before ``t``. All cuts are built in one pass: raw events are read and shuffled once, reduced map-side
to one row per (unit, cut, zone).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import config as C
from farelake.functions import columns as X
from farelake.operators import cdc
from farelake.operators.quality import union_all

UNIT = "unidad_id"
NO_PROFILE = "sin_padron"


class InsufficientData(ValueError):
    """The events end before the label horizon of a cut."""


# ---- inputs ------------------------------------------------------------------------------


def events(silver: dict[str, DataFrame], first_day: date | None = None, end: date | None = None) -> DataFrame:
    """Valid boardings keyed by unit: unidad_id, tarjeta, operador, fecha_hora, monto_gtq, zona.

    With ``first_day`` and ``end`` only the day folders from the one to before the other are read. Cards without a
    usable number have no unit and are left out.
    """

    def part(view, operator, card, ts, zone):
        op = F.lit(operator)
        df = silver[view]
        if first_day is not None and "dia" in df.columns:
            df = df.filter(F.col("dia") >= F.lit(first_day))
        if end is not None and "dia" in df.columns:
            df = df.filter(F.col("dia") < F.lit(end))
        return df.select(
            X.unit_id(op, F.col(card)).alias(UNIT),
            F.col(card).alias("tarjeta"),
            op.alias("operador"),
            F.col(ts).alias("fecha_hora"),
            "monto_gtq",
            F.col(zone).alias("zona"),
        )

    return union_all(
        [
            part("silver_tm_validaciones", C.TRANSMETRO, "tarjeta_tm", "fecha_hora", "zona_canonica"),
            part("silver_tu_transacciones", C.TRANSURBANO, "tarjeta_tu", "fecha_hora", "zona_canonica"),
            part("silver_mr_viajes", C.METRORIEL, "tarjeta_mr", "ts_entrada", "zona_entrada"),
            part("silver_am_boardings", C.AEROMETRO, "tarjeta_am", "fecha_hora", "zona_canonica"),
        ]
    ).filter(F.col(UNIT).isNotNull())


def registry(silver_cdc: DataFrame) -> DataFrame:
    """The change log keyed by unit; events whose card names no person are left out."""
    return silver_cdc.filter(F.col("numero").isNotNull()).select(
        F.concat(F.lit("P"), F.col("numero").cast("string")).alias(UNIT),
        "tarjeta",
        "seq",
        "commit_ts",
        "op",
        "perfil",
    )


def until(df: DataFrame, ts: str, limit) -> DataFrame:
    """Input as it was known at ``limit``; a null limit keeps everything."""
    return df if limit is None else df.filter(F.col(ts) < F.lit(limit).cast("timestamp_ntz"))


# ---- rollups -------------------------------------------------------------------------------


def card_rollup(ev: DataFrame, unit: str = UNIT) -> DataFrame:
    """First day each card of a unit was seen."""
    return ev.groupBy(unit, "tarjeta").agg(F.min(F.col("fecha_hora").cast("date")).alias("primer_dia"))


DAYS_PER_MASK = 62  # days held by one long


def _masks(w: C.CutWindows) -> int:
    return -(-w.window // DAYS_PER_MASK)


def zone_rollup(
    ev: DataFrame, cuts: dict[str, date], w: C.CutWindows, operators: Sequence[str], unit: str = UNIT
) -> DataFrame:
    """One row per unit, cut and zone, holding every partial sum the features need.

    Only fixed-width aggregates meet the raw events, so this runs as generated hash aggregation with
    map-side partials; the active days of the window are bits of longs instead of a set of dates.
    """
    ts = F.col("fecha_hora")
    day = ts.cast("date")
    flat = ev.select(
        unit, "zona", "operador", day.alias("_day"), ts.alias("_ts"),
        X.peak_hour(ts).alias("_is_peak"), X.weekend(ts).alias("_is_weekend"),
        X.cents(F.col("monto_gtq")).alias("_money"),
    )
    rows = at_cuts(flat, cuts, w, (F.col("_day") >= F.col("ini")) & (F.col("_day") < F.col("fin")))
    ago = F.datediff("fecha_corte", "_day")  # 1 … window inside the window, 0 or less after the cut
    inside = ago > 0
    bit = F.pmod(ago - 1, DAYS_PER_MASK)
    masks = [
        F.bit_or(
            F.when(
                inside & (F.floor((ago - 1) / DAYS_PER_MASK) == j),
                F.call_function("shiftleft", F.lit(1).cast("long"), bit),
            )
        ).alias(f"_days_{j}")
        for j in range(_masks(w))
    ]
    return rows.groupBy(unit, "corte", "fecha_corte", "zona").agg(
        F.count_if(inside).alias("_n"),
        F.count_if(inside & (ago <= w.short)).alias("_short"),
        F.count_if(inside & (ago <= w.half)).alias("_half"),
        *[F.count_if(inside & (F.col("operador") == op)).alias(f"_op_{i}") for i, op in enumerate(operators)],
        F.count_if(inside & F.col("_is_peak")).alias("_peak"),
        F.count_if(inside & F.col("_is_weekend")).alias("_weekend"),
        F.sum(F.when(inside, F.col("_money"))).alias("_cents"),
        F.max(F.when(inside, F.col("_ts"))).alias("_last"),
        F.bool_or(~inside).alias("_came_back"),
        *masks,
    )


# ---- cuts -----------------------------------------------------------------------------------


def at_cuts(df: DataFrame, cuts: dict[str, date], w: C.CutWindows, relevant) -> DataFrame:
    """Repeat each row for the cuts it matters to: adds corte, fecha_corte, ini, fin.

    The cuts are a constant list inside the row expression; nothing is joined. ``relevant`` is a
    condition on the row and the added columns, applied right behind the generator so that both stay
    in generated code.
    """
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("corte"),
                F.lit(day).alias("fecha_corte"),
                F.lit(day - timedelta(days=w.window)).alias("ini"),
                F.lit(day + timedelta(days=w.horizon)).alias("fin"),
            )
            for name, day in cuts.items()
        ]
    )
    return df.select("*", F.inline(listed)).filter(relevant)


def _active_days(w: C.CutWindows):
    """The days of the window with a trip, as days before the cut, nearest first."""
    def days_of(j):
        first, last = j * DAYS_PER_MASK, min((j + 1) * DAYS_PER_MASK, w.window) - 1
        mask = F.coalesce(F.col(f"_days_{j}"), F.lit(0).cast("long"))
        held = lambda i: F.getbit(mask, (i - first).cast("int")) == 1
        return F.filter(F.sequence(F.lit(first), F.lit(last)), held)

    parts = [days_of(j) for j in range(_masks(w))]
    return F.concat(*parts)


def _max_gap(days):
    """Longest run of days without a trip between two active days of a short sorted list."""
    gaps = F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(days), F.lit(2))),
        lambda i: F.coalesce(F.get(days, i - 1) - F.get(days, i - 2) - 1, F.lit(0)),
    )
    return F.coalesce(F.array_max(gaps), F.lit(0))


def feature_columns(w: C.CutWindows, operators: Sequence[str]) -> list[str]:
    """Numeric feature names in their published order."""
    return [
        f"viajes_{w.window}d",
        f"viajes_{w.short}d",
        f"viajes_{w.half}d",
        f"tendencia_{w.half}d",
        f"dias_activos_{w.window}d",
        "dias_desde_ultimo_viaje",
        "max_dias_sin_viajar",
        "viajes_por_dia_activo",
        "n_operadores",
        "n_zonas",
        *[f"prop_{_slug(op)}" for op in operators],
        "prop_hora_pico",
        "prop_fin_de_semana",
        f"gasto_{w.window}d",
        "tarifa_promedio",
    ]


def _slug(op: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in op.lower())


def features(
    recent: DataFrame,
    cards: DataFrame,
    log: DataFrame | None,
    cuts: dict[str, date],
    w: C.CutWindows,
    operators: Sequence[str],
    last_event: DataFrame,
    labels: str = "auto",
    unit: str = UNIT,
) -> DataFrame:
    """Features of every cut, stacked, one row per (unit, cut) of the population.

    ``recent`` are the events of the cuts' windows and horizons, ``cards`` the :func:`card_rollup` of
    all history, ``last_event`` a one-row frame with the time of the last event (``ultimo``), and
    ``operators`` every operator that occurs. ``labels``: ``"auto"`` labels a cut only if the data
    reach the end of its horizon (minus a day), else null; ``"none"`` leaves labels null;
    ``"require"`` raises :class:`InsufficientData`.
    """
    if labels == "require":
        _require_horizon(last_event, cuts, w)
    key = [unit, "corte", "fecha_corte"]
    zones = zone_rollup(recent, cuts, w, operators, unit)
    sums = ["_n", "_short", "_half", *[f"_op_{i}" for i in range(len(operators))], "_peak", "_weekend", "_cents"]
    agg = zones.groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max("_last").alias("_last"),
        F.bool_or("_came_back").alias("_came_back"),
        F.count_if(F.col("zona").isNotNull() & (F.col("_n") > 0)).alias("_zones"),
        *[F.bit_or(f"_days_{j}").alias(f"_days_{j}") for j in range(_masks(w))],
    )
    agg = agg.filter(F.col("_n") >= w.min_trips).withColumn("_days", _active_days(w))

    seen = (
        at_cuts(cards, cuts, w, F.col("primer_dia") < F.col("fecha_corte"))
        .groupBy(*key)
        .agg(F.array_join(F.array_sort(F.collect_set("tarjeta")), ";").alias("tarjetas"))
    )
    pop = agg.join(seen, key, "left")
    if log is not None:
        state = registry_at(log, cuts, w, unit)
        pop = pop.join(state, key, "left").filter(
            F.coalesce("ultima_operacion", F.lit("")) != "DELETE"
        )
    else:
        pop = pop.withColumn("perfil", F.lit(None).cast("string"))

    n, days = F.col("_n"), F.col("_days")
    held = [F.coalesce(F.bit_count(f"_days_{j}"), F.lit(0)) for j in range(_masks(w))]
    active = sum(held, F.lit(0)).cast("long")
    spent = X.from_cents(F.col("_cents"))
    t = F.col("fecha_corte").cast("timestamp_ntz")
    named = {
        f"viajes_{w.window}d": n,
        f"viajes_{w.short}d": F.col("_short"),
        f"viajes_{w.half}d": F.col("_half"),
        f"tendencia_{w.half}d": (F.col("_half") + F.lit(1.0)) / (n - F.col("_half") + F.lit(1.0)),
        f"dias_activos_{w.window}d": active,
        "dias_desde_ultimo_viaje": X.seconds_between(F.col("_last"), t) / F.lit(86400.0),
        "max_dias_sin_viajar": _max_gap(days).cast("long"),
        "viajes_por_dia_activo": X.share(n, active),
        "n_operadores": sum((F.col(f"_op_{i}") > 0).cast("long") for i in range(len(operators))),
        "n_zonas": F.col("_zones"),
        **{f"prop_{_slug(op)}": X.share(F.col(f"_op_{i}"), n) for i, op in enumerate(operators)},
        "prop_hora_pico": X.share(F.col("_peak"), n),
        "prop_fin_de_semana": X.share(F.col("_weekend"), n),
        f"gasto_{w.window}d": spent,
        "tarifa_promedio": spent / n,
    }
    went = F.when(F.col("_came_back"), 0).otherwise(1)
    if labels == "none":
        label = F.lit(None).cast("int")
    elif labels == "require":
        label = went
    else:
        label = F.when(F.col("_known_to") >= F.date_add("fecha_corte", w.horizon - 1), went)
        pop = pop.withColumn("_known_to", last_event.select(F.col("ultimo").cast("date")).scalar())
    return pop.select(
        unit,
        "corte",
        "fecha_corte",
        "tarjetas",
        *[c.alias(name) for name, c in named.items()],
        F.coalesce("perfil", F.lit(NO_PROFILE)).alias("perfil"),
        label.alias("etiqueta"),
    )


def registry_at(
    log: DataFrame, cuts: dict[str, date], w: C.CutWindows = C.CutWindows(), unit: str = UNIT
) -> DataFrame:
    """Last operation and profile per unit among the changes committed before each cut."""
    before = at_cuts(log, cuts, w, F.col("commit_ts") < F.col("fecha_corte").cast("timestamp_ntz"))
    state = cdc.current_state(before, [unit, "corte", "fecha_corte"], ["perfil"], extra=())
    return state.select(unit, "corte", "fecha_corte", "perfil", "ultima_operacion")


def _require_horizon(last_event: DataFrame, cuts: dict[str, date], w: C.CutWindows) -> None:
    last = last_event.first()["ultimo"]
    for name, day in cuts.items():
        end = datetime.combine(day, datetime.min.time()) + timedelta(days=w.horizon - 1)
        if last is None or last < end:
            raise InsufficientData(f"cut {name} ({day}): events end at {last}, label needs {end}")


def build(
    ev: DataFrame,
    log: DataFrame | None,
    cuts: dict[str, date],
    w: C.CutWindows = C.CutWindows(),
    operators: Sequence[str] = tuple(C.OPERATOR_CODES),
    labels: str = "auto",
    data_until=None,
    unit: str = UNIT,
) -> DataFrame:
    """Features straight from events and change log, optionally as known at ``data_until``."""
    ev = until(ev, "fecha_hora", data_until)
    log = until(log, "commit_ts", data_until) if log is not None else None
    ts = F.col("fecha_hora")
    first_day = min(cuts.values()) - timedelta(days=w.window)
    end_day = max(cuts.values()) + timedelta(days=w.horizon)
    recent = ev.filter((ts >= X.midnight(first_day)) & (ts < X.midnight(end_day)))
    last_event = ev.agg(F.max(ts).alias("ultimo"))
    return features(recent, card_rollup(ev, unit), log, cuts, w, operators, last_event, labels, unit)


# ---- population questions ---------------------------------------------------------------------


def population(feats: DataFrame) -> DataFrame:
    return feats.groupBy("corte", "fecha_corte").agg(
        F.count(F.lit(1)).alias("poblacion"),
        F.sum("etiqueta").alias("positivos"),
        F.round(X.share(F.sum("etiqueta"), F.count("etiqueta")), 6).alias("tasa_positiva"),
    )


def card_counterfactual(
    ev: DataFrame, log: DataFrame | None, cut: date, w: C.CutWindows = C.CutWindows(), unit: str = UNIT
) -> DataFrame:
    """What a card-based unit would count: population, positives, and positives whose person went on.

    The events are read once: per (card, mode), then per card, then per person with the short list of
    the person's cards, each level with map-side partials. A card belongs to one person.
    """
    t = X.midnight(cut)
    ts = F.col("fecha_hora")
    start = X.midnight(cut - timedelta(days=w.window))
    end = X.midnight(cut + timedelta(days=w.horizon))
    rows = ev.filter((ts >= start) & (ts < end))
    per_mode = rows.groupBy(unit, "tarjeta", "operador").agg(
        F.count_if(ts < t).alias("_n"), F.bool_or(ts >= t).alias("_again")
    )
    # one card may serve several modes: a member per mode, but a later trip under any counts
    per_card = per_mode.groupBy(unit, "tarjeta").agg(
        F.count_if(F.col("_n") >= w.min_trips).alias("_members"), F.bool_or("_again").alias("_card_again")
    )
    per_unit = per_card.groupBy(unit).agg(
        F.bool_or("_card_again").alias("_unit_again"),
        F.collect_list(F.struct("tarjeta", "_members", "_card_again")).alias("_cards"),
    )
    pop = per_unit.select("_unit_again", F.inline("_cards")).filter(F.col("_members") > 0)
    if log is not None:
        known = log.filter(F.col("commit_ts") < t)
        gone = (
            known.groupBy("tarjeta")
            .agg(F.max_by("op", "seq").alias("_op"))
            .filter(F.col("_op") == "DELETE")
            .select("tarjeta")
        )
        pop = pop.join(gone, "tarjeta", "left_anti")
    lost = ~F.col("_card_again")

    def members(cond=F.lit(True)):
        return F.coalesce(F.sum(F.when(cond, F.col("_members"))), F.lit(0))

    return pop.agg(
        members().alias("poblacion_tarjetas"),
        members(lost).alias("positivos_tarjeta"),
        members(lost & F.col("_unit_again")).alias("positivos_de_personas_que_siguieron"),
    ).withColumn(
        "proporcion",
        F.round(
            F.try_divide(F.col("positivos_de_personas_que_siguieron").cast("double"), F.col("positivos_tarjeta")),
            4,
        ),
    )


def subpopulation(feats: DataFrame, member) -> DataFrame:
    """Size and positives of the units ``member`` selects, against the whole population."""
    y = F.col("etiqueta")
    return feats.agg(
        F.count_if(member).alias("unidades"),
        F.count(F.lit(1)).alias("de_la_poblacion"),
        F.coalesce(F.sum(F.when(member, y)), F.lit(0)).alias("positivos"),
        F.coalesce(F.sum(y), F.lit(0)).alias("positivos_totales"),
    )
