"""The flight-shaped view of the supplied star schema.

Each lineitem becomes one flight: brand = airline, supplier nation = source,
customer nation = destination, order date = departure, quantity/2 = duration
in hours, return flag = class, market segment = booking source, order
priority = seasonality, extended price net of discount = base fare, plus
tax = total fare. ``FLIGHTS_SQL`` is the same view as a DuckDB CTE for the
oracle checks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from faresight.session import materialize
from faresight.sources.tables import read_table

# Fixed values of the mapping (they define the view, shared with the SQL below).
STOPOVER_BY_LINE_MOD3 = {0: "Direct", 1: "1 Stop", 2: "2 Stops"}
CLASS_BY_RETURNFLAG = {"A": "Economy", "N": "Business", "R": "First Class"}

def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


def _case(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def flights(spark: SparkSession, sf_dir: str, departing: Callable[[Column], Column] | None = None) -> DataFrame:
    """Raw flight table (17 reference columns plus ``order_key``/``line_no``);
    with ``departing``, only flights whose departure meets the condition: their
    orders are written first, so that the joins know how few they are.

    Join plan: lineitem ⋈ orders ⋈ customer ⋈ part ⋈ supplier ⋈ nation ⋈
    nation. No hints: the planner broadcasts dimensions whose file size is
    under the threshold, AQE re-plans from runtime sizes, and at scale the
    large joins stay sort-merge joins on their keys with skew splitting.
    For repeated analyses at scale, stage the view once
    (``faresight.sources.flights.stage_flights``) and read it back.
    """
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"], spread=True)
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    if departing is not None:
        o = materialize(o.where(departing(F.col("o_orderdate"))))
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nat = _nations(spark, sf_dir)
    dest = nat.select(F.col("n_nationkey").alias("dn_key"), F.col("n_name").alias("dn_name"),
                      F.col("r_name").alias("dr_name"))
    src = nat.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"),
                     F.col("r_name").alias("sr_name"))
    # Orders meet their customers before the lines do, so that the fact rows
    # are not shuffled once more for them; other raw dimensions next, the two
    # nation look-ups last: those keep their own file-size estimates (a join
    # of two is estimated as the product of their sizes). Few written orders
    # go to the lines first, for the same reason.
    lines = (li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey) if departing is None
             else li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey))
    j = (lines
           .join(p, F.col("l_partkey") == p.p_partkey)
           .join(s, F.col("l_suppkey") == s.s_suppkey)
           .join(dest, F.col("c_nationkey") == dest.dn_key)
           .join(src, F.col("s_nationkey") == src.sn_key))
    base = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    dur = F.col("l_quantity") / F.lit(2.0)
    return j.select(
        F.col("p_brand").alias("airline"),
        F.col("sn_name").alias("source"),
        F.concat(F.col("sr_name"), F.lit(" ("), F.col("sn_name"), F.lit(")")).alias("source_name"),
        F.col("dn_name").alias("destination"),
        F.concat(F.col("dr_name"), F.lit(" ("), F.col("dn_name"), F.lit(")")).alias("destination_name"),
        F.col("o_orderdate").alias("departure"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(dur * 3600).cast("decimal(18,6)"))).alias("arrival"),
        dur.alias("duration_hrs"),
        _case(F.col("l_linenumber") % 3, STOPOVER_BY_LINE_MOD3).alias("stopovers"),
        F.col("p_type").alias("aircraft_type"),
        _case(F.col("l_returnflag"), CLASS_BY_RETURNFLAG).alias("travel_class"),
        F.col("c_mktsegment").alias("booking_source"),
        F.col("o_orderpriority").alias("seasonality"),
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("int").alias("days_before"),
        base.alias("base_fare"),
        (base * F.col("l_tax")).alias("tax"),
        (base + base * F.col("l_tax")).alias("total_fare"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
    )


# DuckDB form of the same view; every oracle query starts with this CTE.
FLIGHTS_SQL = """
nat AS (
  SELECT n.n_nationkey, n.n_name, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
flights AS (
  SELECT
    p.p_brand AS airline,
    sn.n_name AS source,
    sn.r_name || ' (' || sn.n_name || ')' AS source_name,
    dn.n_name AS destination,
    dn.r_name || ' (' || dn.n_name || ')' AS destination_name,
    o.o_orderdate AS departure,
    o.o_orderdate + to_microseconds(CAST(l.l_quantity / 2.0 * 3600000000 AS BIGINT)) AS arrival,
    l.l_quantity / 2.0 AS duration_hrs,
    CASE l.l_linenumber % 3 WHEN 0 THEN 'Direct' WHEN 1 THEN '1 Stop' WHEN 2 THEN '2 Stops' END AS stopovers,
    p.p_type AS aircraft_type,
    CASE l.l_returnflag WHEN 'A' THEN 'Economy' WHEN 'N' THEN 'Business' WHEN 'R' THEN 'First Class' END AS travel_class,
    c.c_mktsegment AS booking_source,
    o.o_orderpriority AS seasonality,
    CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS days_before,
    l.l_extendedprice * (1.0 - l.l_discount) AS base_fare,
    l.l_extendedprice * (1.0 - l.l_discount) * l.l_tax AS tax,
    l.l_extendedprice * (1.0 - l.l_discount) + l.l_extendedprice * (1.0 - l.l_discount) * l.l_tax AS total_fare,
    l.l_orderkey AS order_key,
    l.l_linenumber AS line_no
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nat dn ON c.c_nationkey = dn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nat sn ON s.s_nationkey = sn.n_nationkey
)"""


def with_flights(sql_body: str, *extra_ctes: str) -> str:
    """Prefix an oracle query with the flight view (and optional extra CTEs)."""
    ctes = ",\n".join((FLIGHTS_SQL,) + extra_ctes)
    return f"WITH {ctes}\n{sql_body}"


def stage_flights(spark: SparkSession, sf_dir: str, out: str, partition_by: str | None = "departure_month") -> None:
    """Write the view once as parquet, partitioned by departure month, so that
    later analyses read pruned columns and partitions instead of re-joining."""
    f = flights(spark, sf_dir)
    if partition_by == "departure_month":
        f = f.withColumn("departure_month", F.date_format("departure", "yyyy-MM"))
    w = f.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(out)
