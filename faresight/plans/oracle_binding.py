"""The option-table binding written as DuckDB SQL (for ``oracle_sql``).

Written independently from the DataFrame version in
``faresight.sources.binding`` so that the oracle check also covers the
binding itself.
"""

from __future__ import annotations

from faresight.schema import MAJOR_HUBS

HUB_CODES = MAJOR_HUBS[:10]
UT_PREFIX = "- ЮТэйр ЗАО/"


def _code(n: str) -> str:
    hubs = ", ".join(f"'{h}'" for h in HUB_CODES)
    return (f"(CASE WHEN ({n}) < 10 THEN [{hubs}][({n}) + 1] "
            f"ELSE 'X' || lpad(CAST(({n}) AS VARCHAR), 2, '0') END)")


def _car(n: str) -> str:
    return f"('C' || lpad(CAST(({n}) AS VARCHAR), 2, '0'))"


def _dur(m: str) -> str:
    hms = (f"lpad(CAST(CAST(floor((({m}) % 1440)/60) AS INTEGER) AS VARCHAR), 2, '0') || ':' || "
           f"lpad(CAST((({m}) % 60) AS VARCHAR), 2, '0') || ':00'")
    return (f"(CASE WHEN ({m}) >= 1440 THEN CAST(CAST(floor(({m})/1440) AS INTEGER) AS VARCHAR) || '.' || {hms} "
            f"ELSE {hms} END)")


def _ts(hours: str, minutes: str) -> str:
    return (f"strftime(o_orderdate + to_minutes(CAST(({hours})*60 + ({minutes}) AS BIGINT)), "
            f"'%Y-%m-%dT%H:%M:%S')")


def binding_sql() -> str:
    qty = "CAST(l_quantity AS INTEGER)"
    brand = "CAST(substring(p_brand, 7) AS INTEGER)"
    d = {0: "(45 + (l_partkey*37) % 1700)", 1: "(45 + (l_suppkey*53) % 900)"}
    h0 = f"({qty}*24 + p_size)"
    h = {0: h0, 1: f"({h0} + 48 + (p_size % 7)*24 + l_suppkey % 24)"}
    n = {0: "(1 + l_partkey % 3)", 1: "(1 + l_suppkey % 2)"}
    ex = {0: "TRUE", 1: "(l_linestatus = 'O')"}
    origin = {0: _code("c_nationkey"), 1: _code("s_nationkey")}
    dest = {0: _code("s_nationkey"), 1: _code("c_nationkey")}
    ff1 = _car("c_custkey % 25 + 1")
    ff2 = _car("(c_custkey + 7) % 25 + 1")
    cols = [
        "l_orderkey*1000000000 + CAST(round(l_extendedprice*100) AS BIGINT) AS Id",
        "'S' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS ranker_id",
        "o_custkey AS profileId",
        "c_nationkey AS companyID",
        "c_nationkey AS nationality",
        "(c_custkey % 2 = 0) AS sex",
        "(c_mktsegment = 'MACHINERY') AS isVip",
        "(c_acctbal > 0) AS bySelf",
        "(l_linestatus = 'F') AS isAccess3D",
        (f"CASE c_custkey % 5 WHEN 1 THEN '' WHEN 2 THEN {ff1} WHEN 3 THEN {ff1} || '/' || {ff2} "
         f"WHEN 4 THEN '{UT_PREFIX}' || {ff1} END AS frequentFlyer"),
        "CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 100 END AS corporateTariffCode",
        "o_orderdate AS requestDate",
        f"{_code('c_nationkey')} || {_code('s_nationkey')} AS searchRoute",
        "l_extendedprice AS totalPrice",
        "l_extendedprice*l_tax AS taxes",
        "CASE WHEN p_size % 4 <> 0 THEN l_discount*1000 END AS miniRules0_monetaryAmount",
        "CASE WHEN p_size % 6 = 0 THEN l_discount*100 END AS miniRules0_percentage",
        "CASE WHEN p_size % 3 <> 0 THEN l_tax*1000 END AS miniRules1_monetaryAmount",
        "CASE WHEN p_size % 5 = 0 THEN l_tax*100 END AS miniRules1_percentage",
    ]
    for L in (0, 1):
        cols += [
            f"CASE WHEN {ex[L]} THEN {_ts(h[L], '0')} END AS legs{L}_departureAt",
            f"CASE WHEN {ex[L]} THEN {_ts(h[L], d[L])} END AS legs{L}_arrivalAt",
            f"CASE WHEN {ex[L]} THEN {_dur(d[L])} END AS legs{L}_duration",
        ]
    for L in (0, 1):
        for S in range(4):
            e = f"({ex[L]} AND {S} < {n[L]})"
            arr = f"(CASE WHEN {S} = {n[L]} - 1 THEN {dest[L]} ELSE {_code(f'(l_partkey + {S} + 1) % 25')} END)"
            dep = origin[L] if S == 0 else _code(f"(l_partkey + {S}) % 25")
            mkt = _car(f"({brand} + {S} + {3 * L} - 1) % 25 + 1")
            op = f"(CASE WHEN p_size % 5 = 0 THEN {_car(f'({brand} + {S} + {3 * L}) % 25 + 1')} ELSE {mkt} END)"
            btype = "CAST(l_suppkey % 2 AS INTEGER)"
            p = f"legs{L}_segments{S}_"
            cols += [
                f"CASE WHEN {e} THEN {dep} END AS {p}departureFrom_airport_iata",
                f"CASE WHEN {e} THEN {arr} END AS {p}arrivalTo_airport_iata",
                f"CASE WHEN {e} THEN {arr} END AS {p}arrivalTo_airport_city_iata",
                f"CASE WHEN {e} THEN {mkt} END AS {p}marketingCarrier_code",
                f"CASE WHEN {e} THEN {op} END AS {p}operatingCarrier_code",
                f"CASE WHEN {e} THEN substring(p_type, 1, 3) || '{S}' END AS {p}aircraft_code",
                f"CASE WHEN {e} THEN {_dur(f'CAST(floor({d[L]} / {n[L]}) AS INTEGER)')} END AS {p}duration",
                f"CASE WHEN {e} THEN CAST(1 + (p_size + {S}) % 3 AS INTEGER) END AS {p}cabinClass",
                f"CASE WHEN {e} THEN CAST(1 + ({qty} + {S}) % 9 AS INTEGER) END AS {p}seatsAvailable",
                (f"CASE WHEN {e} THEN CAST(CASE WHEN {btype} = 0 THEN p_size % 3 ELSE 10 + p_size % 20 END AS INTEGER) "
                 f"END AS {p}baggageAllowance_quantity"),
                f"CASE WHEN {e} THEN {btype} END AS {p}baggageAllowance_weightMeasurementType",
            ]
    cols.append("CASE WHEN o_orderstatus <> 'P' AND row_number() OVER (PARTITION BY l_orderkey "
                "ORDER BY l_discount DESC, l_extendedprice) = 1 THEN 1 ELSE 0 END AS selected")
    body = ",\n  ".join(cols)
    return (f"SELECT\n  {body}\nFROM lineitem JOIN orders ON l_orderkey = o_orderkey "
            f"JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey "
            f"JOIN part ON l_partkey = p_partkey")


def with_candidates(*ctes: tuple[str, str], final: str) -> str:
    """``WITH candidates AS (binding), <ctes…> <final>``."""
    parts = [f"candidates AS (\n{binding_sql()}\n)"] + [f"{name} AS (\n{sql}\n)" for name, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final
