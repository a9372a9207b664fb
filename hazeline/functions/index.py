"""Regulatory air-quality index: sub-indices, overall index, band, dominant pollutant.

All pieces are SQL CASE expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.schema import BAND_LIMITS, BANDS, BREAKPOINTS, GAS_NAMES, GASES, INDEX_LEVELS


def sub_index(gas: str, value: str) -> Column:
    """Piecewise linear sub-index of one gas; ``value`` is a column name or SQL expression.

    A missing value or an unknown gas gives 0; below zero the first segment is
    extended; beyond the last breakpoint the index is 400 plus the excess.
    """
    if gas not in BREAKPOINTS:
        return F.lit(0.0)
    conc, arms = BREAKPOINTS[gas], []
    for c0, c1, i0, i1 in zip(conc, conc[1:], INDEX_LEVELS, INDEX_LEVELS[1:]):
        arms.append(f"WHEN {value} <= {c1} THEN ({value} - {c0}) * {(i1 - i0) / (c1 - c0)!r}D + {i0}")
    return F.expr(f"CASE WHEN {value} IS NULL OR isnan({value}) THEN 0D {' '.join(arms)} "
                  f"ELSE {value} - {conc[-1]} + {INDEX_LEVELS[-1]} END")


def band(index: str) -> Column:
    """Band of an unrounded index value."""
    arms = " ".join(f"WHEN {index} <= {limit} THEN '{name}'" for limit, name in zip(BAND_LIMITS, BANDS))
    return F.expr(f"CASE {arms} ELSE '{BANDS[-1]}' END")


def add_index(df: DataFrame, gases: dict[str, str] | None = None,
              co_divisor: float = 1.0, keep_parts: bool = False) -> DataFrame:
    """Append ``aqi``, ``band`` and ``dominant``.

    ``gases`` maps gas keys to columns. Breakpoints of CO are in mg/m3: pass
    ``co_divisor=1000`` when the column holds ug/m3. A row without any value
    gets 0, "N/A" and "None". Ties go to the first gas in the order PM2.5, PM10,
    NO2, CO, SO2, O3.
    """
    gases = gases or {g: g for g in GASES}
    used = [g for g in GASES if g in gases]
    if not used:
        return df.withColumns({"aqi": F.lit(0.0), "band": F.lit("N/A"), "dominant": F.lit("None")})
    raw = {g: f"CAST(`{gases[g]}` AS DOUBLE)" for g in used}
    values = {g: f"({v} / {co_divisor!r}D)" if g == "co" and co_divisor != 1.0 else v for g, v in raw.items()}
    parts = {f"idx_{g}": sub_index(g, values[g]) for g in used}
    df = df.withColumns(parts)
    names = list(parts)
    df = df.withColumn("_top", F.greatest(*names) if len(names) > 1 else F.col(names[0]))
    empty = " AND ".join(f"({v} IS NULL OR isnan({v}))" for v in raw.values())
    first = " ".join(f"WHEN idx_{g} = _top THEN '{GAS_NAMES[g]}'" for g in used)
    df = df.withColumns({
        "aqi": F.expr(f"CASE WHEN {empty} THEN 0D ELSE round(_top * 100) / 100 END"),
        "band": F.when(F.expr(empty), "N/A").otherwise(band("_top")),
        "dominant": F.expr(f"CASE WHEN {empty} THEN 'None' {first} END"),
    })
    return df.drop("_top", *([] if keep_parts else names))


def eligible(gases: dict[str, str] | None = None) -> Column:
    """At least three gases present, one of them a particulate."""
    gases = gases or {g: g for g in GASES}
    present = {g: f"(`{c}` IS NOT NULL AND NOT isnan(`{c}`))" for g, c in gases.items()}
    total = " + ".join(f"CAST({p} AS INT)" for p in present.values())
    particulate = " OR ".join([present[g] for g in ("pm25", "pm10") if g in present] or ["false"])
    return F.expr(f"({total}) >= 3 AND ({particulate})")
