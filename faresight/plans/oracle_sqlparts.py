"""Reusable DuckDB SQL fragments for the oracle queries."""

from __future__ import annotations

from faresight.schema import MAJOR_HUBS

HUBS_SQL = "(" + ", ".join(f"'{h}'" for h in MAJOR_HUBS) + ")"


def dur_sql(c: str) -> str:
    """Duration text → minutes (null, '', malformed → 0): the text cut at its
    separators; 31 to 89 seconds are one minute, more are two."""
    p = f"string_split(replace({c}, '.', ':'), ':')"

    def n(i):
        return f"CAST({p}[{i}] AS INTEGER)"
    return (f"(CASE WHEN regexp_full_match({c}, '([0-9]+[.])?[0-9][0-9](:[0-9][0-9])(:[0-9][0-9])') THEN "
            f"(CASE WHEN len({p}) = 4 THEN {n(1)} * 1440 ELSE 0 END) + {n(-3)} * 60 + {n(-2)} "
            f"+ (CASE WHEN {n(-1)} <= 30 THEN 0 WHEN {n(-1)} < 90 THEN 1 ELSE 2 END) ELSE 0 END)")


def seg(L, S, a):
    return f"legs{L}_segments{S}_{a}"


def base_cte() -> str:
    """candidates + parsed times and durations."""
    return f"""SELECT *,
  {dur_sql('legs0_duration')} AS leg0_duration_minutes,
  {dur_sql('legs1_duration')} AS leg1_duration_minutes,
  {dur_sql('legs0_duration')} + {dur_sql('legs1_duration')} AS trip_duration_minutes,
  TRY_CAST(legs0_departureAt AS TIMESTAMP) AS dep0,
  TRY_CAST(legs0_arrivalAt AS TIMESTAMP) AS arr0,
  TRY_CAST(legs1_departureAt AS TIMESTAMP) AS dep1,
  TRY_CAST(legs1_arrivalAt AS TIMESTAMP) AS arr1
FROM candidates"""


def lead_sql(dep="dep0", req="requestDate"):
    return f"CAST(trunc((epoch({dep}) - epoch({req})) / 86400.0) AS INTEGER)"


def row_mean_sql(cols):
    s = " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in cols)
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    return f"(CASE WHEN ({n}) > 0 THEN ({s}) / ({n}) END)"


def clip_sql(x, lo=None, hi=None):
    e = x
    if lo is not None:
        e = f"greatest({e}, {lo})"
    if hi is not None:
        e = f"least({e}, {hi})"
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE {e} END)"


def mode_cte(src: str, key: str, value_expr: str, where: str, out: str) -> str:
    """Most frequent non-null value per key, smallest on ties."""
    return f"""SELECT {key}, (array_agg(v ORDER BY c DESC, v))[1] AS {out}
FROM (SELECT {key}, {value_expr} AS v, count(*) AS c FROM {src}
      WHERE ({where}) AND ({value_expr}) IS NOT NULL GROUP BY {key}, {value_expr}) t
GROUP BY {key}"""


def fill0(x, kind, rounded=True):
    if kind == "d":
        e = f"CASE WHEN isnan(coalesce({x}, 0)) THEN 0 ELSE coalesce({x}, 0) END"
        return f"round({e}, 6)" if rounded else e
    if kind == "i":
        return f"CAST(coalesce({x}, 0) AS BIGINT)"
    return x
