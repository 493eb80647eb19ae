"""Feature table of the isolation forest: one row per transaction, no nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.functions.columns import DAY_MICROS, MICROS, wall_micros
from txwatch.functions.hotkeys import sliced_running_sums
from txwatch.params import Params

# Names and order of the features.
FEATURE_COLUMNS = (
    "valor",
    "log_valor",
    "hora",
    "dia_semana",
    "freq_7d",
    "freq_30d",
    "destinos_unicos_30d",
    "idade_conta_dias",
    "score_risco_assoc",
    "ratio_valor_ticket_medio",
    "distancia_geo_padrao",
)

_KEY = "associado_id"
_COUNTS = ["freq_7d", "freq_30d", "destinos_unicos_30d"]
_PAYLOAD = ["transacao_id", "valor", "hora", "dia_semana", "idade", "risco", "lat", "lon"]
_STATS = ["ticket", "lat_mediana", "lon_mediana"]
#: Width of a slice of coordinates, in degrees; a power of two, so slice edges are exact.
_DEGREES = 2.0**-4


def member_features(silver: DataFrame, params: Params, keep: tuple[str, ...] = ()) -> DataFrame:
    """transacao_id, the eleven features and the columns `keep` of `silver`; NaN counts as missing.

    A count over the last 7 or 30 days is the member's count so far less the count of what has left.
    Both only ever grow along the time line, so the cost is linear in the history whatever its length.
    One algorithm serves members of every size: what happens at one instant is combined first, running
    totals are taken over slices of the time line, and rows get them back by (member, instant).

    `silver` is read more than once and should be a stored table.
    """
    rows = _prepare(silver, keep)
    known = rows.where(f"{_KEY} is not null")
    measured = known.join(_counts(known, params), [_KEY, "_t"]).join(_stats(known), _KEY, "left")
    columns = [_KEY, *_PAYLOAD, *keep, *_STATS, *_COUNTS]
    return _finish(measured.select(*columns).unionByName(_orphans(rows.where(f"{_KEY} is null"), keep)), keep)


def _prepare(silver: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    has = set(silver.columns)
    since = "dt_adesao" if "dt_adesao" in has else "cast(null as date)"
    risk = "score_risco" if "score_risco" in has else "cast(null as double)"
    return silver.select(
        _KEY,
        "transacao_id",
        "conta_destino",
        wall_micros("dt_transacao").alias("_t"),
        F.expr("nanvl(cast(valor as double), null) as valor"),
        F.expr("hour(dt_transacao) as hora"),
        F.expr("weekday(dt_transacao) as dia_semana"),
        F.expr(f"greatest(coalesce(datediff(to_date(dt_transacao), {since}), 0), 0) as idade"),
        F.expr(f"coalesce(nanvl({risk}, null), 0.3D) as risco"),
        F.expr("nanvl(geo_lat, null) as lat"),
        F.expr("nanvl(geo_lon, null) as lon"),
        *keep,
    )


def _counts(rows: DataFrame, params: Params) -> DataFrame:
    """Per member and instant the three counts, rows of that instant included."""
    week, month = 7 * DAY_MICROS, 30 * DAY_MICROS
    marks = (
        "explode(array(struct(_t as t, n as now, n as week, n as month), "
        f"struct(_t + {week} as t, 0L as now, -n as week, 0L as month), "
        f"struct(_t + {month} as t, 0L as now, 0L as week, -n as month))) as _m"
    )
    instants = rows.groupBy(_KEY, "_t").agg(F.expr("count(*) as n"))
    times = instants.selectExpr(_KEY, marks).selectExpr(
        _KEY, "_m.t as _t", "_m.now as _now", "_m.week as freq_7d", "_m.month as freq_30d", "0L as destinos_unicos_30d"
    )
    first = rows.where("conta_destino is not null").groupBy(_KEY, "conta_destino")
    first = first.agg(F.expr("min(_t) as _t")).groupBy(_KEY, "_t").agg(F.expr("count(*) as n")).selectExpr(
        _KEY, "_t", "0L as _now", "0L as freq_7d", "0L as freq_30d", "n as destinos_unicos_30d"
    )
    # At most four rows an instant; running totals count them all, and its transactions keep one.
    line = times.unionByName(first)
    summed = sliced_running_sums(line, _KEY, "_t", _COUNTS, params.slice_seconds * MICROS)
    return summed.where("_now > 0").drop("_now")


def _stats(rows: DataFrame) -> DataFrame:
    """Mean amount and median coordinates per member.

    A median is found by counting: equal coordinates are combined, running counts over slices of the
    axis give every value its ranks, and the one or two middle ranks are averaged.
    """
    axes = rows.selectExpr(_KEY, "stack(2, 'lat', lat, 'lon', lon) as (_axis, _value)").where("_value is not null")
    axes = axes.withColumn("_line", F.struct(_KEY, "_axis"))
    times = axes.groupBy("_line", "_value").agg(F.expr("count(*) as _times"))
    ends = sliced_running_sums(times.selectExpr("*", "_times as _end"), "_line", "_value", ["_end"], _DEGREES)
    totals = axes.groupBy("_line").agg(F.expr("count(*) as _n"))
    middle = ends.join(totals, "_line").where(
        "_end - _times <= floor(_n / 2) and floor((_n - 1) / 2) < _end"
    )
    medians = middle.groupBy("_line").agg(F.expr("(min(_value) + max(_value)) / 2 as _median"))
    by_member = medians.groupBy(F.col(f"_line.{_KEY}").alias(_KEY)).agg(
        *[F.expr(f"max(if(_line._axis = '{a}', _median, null)) as {a}_mediana") for a in ("lat", "lon")]
    )
    return rows.groupBy(_KEY).agg(F.expr("avg(valor) as ticket")).join(by_member, _KEY, "left")


def _orphans(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Rows without a member have no history; they need no shuffle."""
    return rows.selectExpr(
        _KEY,
        *_PAYLOAD,
        *keep,
        *[f"cast(null as double) as {c}" for c in _STATS],
        *[f"0L as {c}" for c in _COUNTS],
    )


def _finish(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    # A missing coordinate stands for the member's own median.
    north = "if(lat_mediana is null, null, coalesce(lat - lat_mediana, 0.0D))"
    east = "if(lon_mediana is null, null, coalesce(lon - lon_mediana, 0.0D))"
    features = {
        "log_valor": "log1p(greatest(valor, 0.01D))",
        "idade_conta_dias": "idade",
        "score_risco_assoc": "risco",
        "ratio_valor_ticket_medio": "coalesce(try_divide(valor, ticket), 1.0D)",
        "distancia_geo_padrao": f"sqrt(pow({north}, 2) + pow({east}, 2))",
    }
    return rows.selectExpr(
        "transacao_id",
        *keep,
        *[
            f"coalesce(cast({features.get(name, name)} as double), 0.0D) as {name}"
            for name in FEATURE_COLUMNS
        ],
    )
