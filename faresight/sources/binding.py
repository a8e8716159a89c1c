"""Binding of the driver's star schema to the option table the engine expects.

One lineitem = one option shown; one order = one search session
(``ranker_id``); the order's customer = the searching customer.  The mapping
is fixed (see FIXTURES.md §2) and deterministic, so Spark and the DuckDB
oracle produce identical rows.

Scale: each side is completed before lineitem ⋈ orders, the large join on the
order key: customer is joined to orders (a row per session, not per option),
supplier and part to the few columns of lineitem, with part's texts already
cut to what is used.  Sides are left to AQE, which turns one into a broadcast
only when its *measured* size is below the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.schema import LEGS, MAJOR_HUBS, SEGMENTS
from faresight.session import compiled_methods
from faresight.sources.tables import read_table

# Fixed values of the binding: places 0 to 9 are the first ten hubs.
HUB_CODES = MAJOR_HUBS[:10]
UT_PREFIX = "- ЮТэйр ЗАО/"


def _table(texts: list[str], n: Column) -> Column:
    """Text number ``n`` of a fixed list; null outside it."""
    return F.get(F.split(F.lit(",".join(texts)), ","), n.cast("int"))


TWO_DIGITS = [f"{i:02d}" for i in range(100)]


def _two(n: Column) -> Column:
    """``lpad(n, 2, '0')``, looked up where n has at most two digits."""
    return F.when((n >= 0) & (n < 100), _table(TWO_DIGITS, n)).otherwise(F.lpad(n.cast("string"), 2, "0"))


def _code(n: Column) -> Column:
    return F.when(n < 100, _table(HUB_CODES + [f"X{x}" for x in TWO_DIGITS[10:]], n)).otherwise(
        F.concat(F.lit("X"), F.lpad(n.cast("string"), 2, "0")))


def _car(n: Column) -> Column:
    return F.when((n >= 0) & (n < 100), _table([f"C{x}" for x in TWO_DIGITS], n)).otherwise(
        F.concat(F.lit("C"), F.lpad(n.cast("string"), 2, "0")))


def _idiv(a: Column, b) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def _dur(m: Column) -> Column:
    hh, mm = _two(_idiv(m % 1440, 60)), _two(m % 60)
    hms = F.concat(hh, F.lit(":"), mm, F.lit(":00"))
    return F.when(m >= 1440, F.concat(_idiv(m, 1440).cast("string"), F.lit("."), hms)).otherwise(hms)


def _iso(t: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss``: years of four digits are put together from looked-up parts, others are formatted."""
    def two(n):
        return _table(TWO_DIGITS, n)

    parts = F.concat(F.year(t).cast("string"), F.lit("-"), two(F.month(t)), F.lit("-"), two(F.day(t)), F.lit("T"),
                     two(F.hour(t)), F.lit(":"), two(F.minute(t)), F.lit(":"), two(F.second(t)))
    return F.when(F.year(t).between(1000, 9999), parts).otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"))


def _ts(t: Column, hours: Column, minutes) -> Column:
    return _iso(F.timestamp_add("MINUTE", (hours * 60 + minutes).cast("long"), t))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The option table: 114 columns, one row per lineitem (FIXTURES.md §1)."""
    return options_of(offers(spark, sf_dir))


#: Columns of the option table that ``offers`` has already, each row's key, session, customer, route, price and label.
OFFER_KEYS = ["Id", "ranker_id", "profileId", "searchRoute", "totalPrice", "selected"]


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined tables: ``OFFER_KEYS`` and the few columns that ``options_of`` makes the others of, one row per lineitem."""
    compiled_methods(spark)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_linestatus")
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cu = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", (F.col("c_mktsegment") == "MACHINERY").alias("_vip"))
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    pa = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.substr(F.col("p_brand"), F.lit(7)).cast("int").alias("_brand"),
        F.substr(F.col("p_type"), F.lit(1), F.lit(3)).alias("_type"), "p_size")

    # the offer a session takes: largest discount, then lowest price; combined map-side, so a hot session is one row per task
    offer = F.struct((-F.col("l_discount")).alias("a"), F.col("l_extendedprice").alias("b"))
    taken = li.groupBy(F.col("l_orderkey").alias("_order")).agg(F.min(offer).alias("_taken"))
    options = li.join(su, li.l_suppkey == su.s_suppkey).join(pa, li.l_partkey == pa.p_partkey)
    sessions = od.join(cu, od.o_custkey == cu.c_custkey)
    j = (options.join(sessions, F.col("l_orderkey") == F.col("o_orderkey"))
                .join(taken, F.col("l_orderkey") == F.col("_order")))

    c = F.col
    return j.select(
        (c("l_orderkey") * 1000000000 + F.round(c("l_extendedprice") * 100).cast("long")).alias("Id"),
        F.concat(F.lit("S"), F.lpad(c("l_orderkey").cast("string"), 8, "0")).alias("ranker_id"),
        c("o_custkey").alias("profileId"),
        F.concat(_code(c("c_nationkey")), _code(c("s_nationkey"))).alias("searchRoute"),
        c("l_extendedprice").alias("totalPrice"),
        F.when((c("o_orderstatus") != "P") & (offer == c("_taken")), 1).otherwise(0).alias("selected"),
        "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_linestatus", "o_orderdate", "c_nationkey", "c_acctbal", "_vip",
        "s_nationkey", "_brand", "_type", "p_size")


def options_of(rows: DataFrame, keep=()) -> DataFrame:
    """``offers`` as the option table, row by row, and the columns ``keep`` as they are."""
    c = F.col
    qty = c("l_quantity").cast("int")
    brand = c("_brand")
    # an option's customer is its order's
    custkey = c("profileId")
    cust_code, supp_code = _code(c("c_nationkey")), _code(c("s_nationkey"))
    d = {0: 45 + (c("l_partkey") * 37) % 1700, 1: 45 + (c("l_suppkey") * 53) % 900}
    h0 = qty * 24 + c("p_size")
    h = {0: h0, 1: h0 + 48 + (c("p_size") % 7) * 24 + c("l_suppkey") % 24}
    nseg = {0: 1 + c("l_partkey") % 3, 1: 1 + c("l_suppkey") % 2}
    leg_exists = {0: F.lit(True), 1: c("l_linestatus") == "O"}
    origin = {0: cust_code, 1: supp_code}
    dest = {0: supp_code, 1: cust_code}

    ff_mod = custkey % 5
    ff1 = _car(custkey % 25 + 1)
    ff2 = _car((custkey + 7) % 25 + 1)

    cols = [
        c("Id"), c("ranker_id"), c("profileId"),
        c("c_nationkey").alias("companyID"),
        c("c_nationkey").alias("nationality"),
        (custkey % 2 == 0).alias("sex"),
        c("_vip").alias("isVip"),
        (c("c_acctbal") > 0).alias("bySelf"),
        (c("l_linestatus") == "F").alias("isAccess3D"),
        F.when(ff_mod == 1, F.lit("")).when(ff_mod == 2, ff1)
         .when(ff_mod == 3, F.concat(ff1, F.lit("/"), ff2))
         .when(ff_mod == 4, F.concat(F.lit(UT_PREFIX), ff1)).alias("frequentFlyer"),
        F.when(custkey % 3 == 0, custkey % 100).alias("corporateTariffCode"),
        c("o_orderdate").alias("requestDate"),
        c("searchRoute"), c("totalPrice"),
        (c("totalPrice") * c("l_tax")).alias("taxes"),
        F.when(c("p_size") % 4 != 0, c("l_discount") * 1000).alias("miniRules0_monetaryAmount"),
        F.when(c("p_size") % 6 == 0, c("l_discount") * 100).alias("miniRules0_percentage"),
        F.when(c("p_size") % 3 != 0, c("l_tax") * 1000).alias("miniRules1_monetaryAmount"),
        F.when(c("p_size") % 5 == 0, c("l_tax") * 100).alias("miniRules1_percentage"),
    ]
    for L in LEGS:
        ex = leg_exists[L]
        start = F.when(ex, c("o_orderdate"))
        cols += [
            _ts(start, h[L], F.lit(0)).alias(f"legs{L}_departureAt"),
            _ts(start, h[L], d[L]).alias(f"legs{L}_arrivalAt"),
            F.when(ex, _dur(d[L])).alias(f"legs{L}_duration"),
        ]
    for L in LEGS:
        for S in SEGMENTS:
            ex = leg_exists[L] & (F.lit(S) < nseg[L])
            last = F.lit(S) == nseg[L] - 1
            arr = F.when(last, dest[L]).otherwise(_code((c("l_partkey") + S + 1) % 25))
            mkt = _car((brand + S + 3 * L - 1) % 25 + 1)
            op = F.when(c("p_size") % 5 == 0, _car((brand + S + 3 * L) % 25 + 1)).otherwise(mkt)
            btype = (c("l_suppkey") % 2).cast("int")
            p = f"legs{L}_segments{S}_"
            cols += [
                F.when(ex, origin[L] if S == 0 else _code((c("l_partkey") + S) % 25)).alias(p + "departureFrom_airport_iata"),
                F.when(ex, arr).alias(p + "arrivalTo_airport_iata"),
                F.when(ex, arr).alias(p + "arrivalTo_airport_city_iata"),
                F.when(ex, mkt).alias(p + "marketingCarrier_code"),
                F.when(ex, op).alias(p + "operatingCarrier_code"),
                F.when(ex, F.concat(c("_type"), F.lit(str(S)))).alias(p + "aircraft_code"),
                F.when(ex, _dur(F.floor(d[L] / nseg[L]).cast("int"))).alias(p + "duration"),
                F.when(ex, (1 + (c("p_size") + S) % 3).cast("int")).alias(p + "cabinClass"),
                F.when(ex, (1 + (qty + S) % 9).cast("int")).alias(p + "seatsAvailable"),
                F.when(ex, F.when(btype == 0, c("p_size") % 3).otherwise(10 + c("p_size") % 20).cast("int"))
                 .alias(p + "baggageAllowance_quantity"),
                F.when(ex, btype).alias(p + "baggageAllowance_weightMeasurementType"),
            ]
    return rows.select(*cols, c("selected"), *keep)
