"""Domain tables derived from the given star-schema tables, as DataFrames and as the same SQL.

Facilities are suppliers, districts nations and regions regions; monthly reports come from line items.
Each derivation reduces its fact table to the natural key of the domain table in one aggregation.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.climate import district_cells
from ..plans.outliers import routine_long
from ..sources.staging import stage

SIZE = 0.05  # square size for shapes about half a degree wide
INDICATORS = ["SUSP", "TEST", "CONF", "PRES"]
CARE = ["MALTREAT", "MALADM", "MALDTH", "ALLADM", "ALLDTH", "ALLOUT"]

VIEWS: dict[str, str] = {}

VIEWS["v_admin"] = """
SELECT 'R' || r_regionkey AS ADM1_ID, r_name AS ADM1_NAME,
       'D' || n_nationkey AS ADM2_ID, n_name AS ADM2_NAME
FROM nation JOIN region ON n_regionkey = r_regionkey"""

VIEWS["v_pyramid"] = """
SELECT 'F' || s_suppkey AS OU_ID,
       CASE WHEN s_acctbal > 9000 THEN s_name || ' FERMEE' ELSE s_name END AS OU_NAME,
       a.ADM1_ID, a.ADM1_NAME, a.ADM2_ID, a.ADM2_NAME,
       CASE WHEN s_acctbal >= 0 THEN DATE '1994-01-01' + (CAST(floor(s_acctbal) AS INTEGER) % 1500) END
         AS OPENING_DATE,
       CASE WHEN s_acctbal > 5000 THEN DATE '1997-01-01' + (CAST(floor(s_acctbal) AS INTEGER) % 2500) END
         AS CLOSED_DATE
FROM supplier JOIN v_admin a ON a.ADM2_ID = 'D' || s_nationkey"""

VIEWS["v_facts"] = """
SELECT 'F' || l_suppkey AS OU_ID, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS PERIOD,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS SUSP,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS TEST,
  sum(floor(l_quantity / 2)) FILTER (WHERE l_returnflag = 'R' AND l_discount < 0.08) AS CONF,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'F') AS PRES,
  sum(l_linenumber) FILTER (WHERE l_returnflag = 'R' AND l_discount < 0.055) * 3.0 AS MALTREAT,
  sum(l_quantity) FILTER (WHERE l_returnflag = 'A' AND l_discount >= 0.045) AS MALADM,
  sum(l_linenumber) FILTER (WHERE l_returnflag = 'A' AND l_discount >= 0.075) * 1.0 AS MALDTH,
  sum(l_quantity) FILTER (WHERE l_discount >= 0.035) AS ALLADM,
  sum(l_linenumber) FILTER (WHERE l_discount >= 0.055) * 1.0 AS ALLDTH,
  sum(l_quantity) AS ALLOUT
FROM lineitem GROUP BY 1, 2"""

VIEWS["v_routine"] = """
SELECT f.PERIOD, CAST(f.PERIOD // 100 AS INTEGER) AS YEAR, CAST(f.PERIOD % 100 AS INTEGER) AS MONTH,
  p.ADM1_ID, p.ADM1_NAME, p.ADM2_ID, p.ADM2_NAME, f.OU_ID, p.OU_NAME,
  SUSP, TEST, CONF, PRES, MALTREAT, MALADM, MALDTH, ALLADM, ALLDTH, ALLOUT
FROM v_facts f JOIN v_pyramid p USING (OU_ID)"""

VIEWS["v_long"] = """
SELECT PERIOD, YEAR, MONTH, ADM1_ID, ADM2_ID, OU_ID, INDICATOR, VALUE FROM (
  SELECT PERIOD, YEAR, MONTH, ADM1_ID, ADM2_ID, OU_ID, u.INDICATOR,
    CASE u.INDICATOR WHEN 'SUSP' THEN SUSP WHEN 'TEST' THEN TEST WHEN 'CONF' THEN CONF ELSE PRES END AS VALUE
  FROM v_routine CROSS JOIN (VALUES ('SUSP'), ('TEST'), ('CONF'), ('PRES')) u(INDICATOR))"""

VIEWS["v_raw"] = """
SELECT l_returnflag AS DX, l_linestatus AS CO, 'F' || l_suppkey AS OU,
  CAST(year(l_shipdate) * 100 + month(l_shipdate) AS VARCHAR) AS PE,
  CASE WHEN sum(l_quantity) = 13 THEN 'n/a' WHEN sum(l_quantity) = 17 THEN NULL
       ELSE CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) || '.5' END AS VALUE
FROM lineitem GROUP BY ALL"""

VIEWS["v_dup"] = """
SELECT 'F' || l_suppkey AS OU_ID, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS PERIOD,
  l_returnflag AS INDICATOR, l_quantity AS VALUE, l_orderkey, l_linenumber, l_extendedprice
FROM lineitem"""

VIEWS["v_population"] = """
SELECT a.ADM1_ID, a.ADM1_NAME, a.ADM2_ID, a.ADM2_NAME, o.YEAR, o.n * 10.0 AS POPULATION,
  o.n_fin * 2.0 AS POP_UNDER_5
FROM (SELECT 'D' || c_nationkey AS ADM2_ID, CAST(year(o_orderdate) AS INTEGER) AS YEAR, count(*) AS n,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS n_fin
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) o
JOIN v_admin a USING (ADM2_ID)"""

VIEWS["v_reports"] = """
SELECT PERIOD, CAST(PERIOD // 100 AS INTEGER) AS YEAR, CAST(PERIOD % 100 AS INTEGER) AS MONTH, OU_ID, ADM2_ID, PRODUCT_UID, PRODUCT_METRIC,
  CASE WHEN PRODUCT_METRIC = 'EXPECTED_REPORTS' THEN 1.0 WHEN top > 150000 THEN 1.0 ELSE 0.0 END AS VALUE
FROM (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS PERIOD, 'C' || o_custkey AS OU_ID,
        'D' || c_nationkey AS ADM2_ID, o_orderstatus AS PRODUCT_UID, max(o_totalprice) AS top
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4)
CROSS JOIN (VALUES ('ACTUAL_REPORTS'), ('EXPECTED_REPORTS')) m(PRODUCT_METRIC)"""

VIEWS["v_rate"] = """
SELECT ADM2_ID, YEAR, MONTH, sum(CASE WHEN CONF IS NOT NULL THEN 1.0 ELSE 0.0 END) / count(*) AS REPORTING_RATE
FROM v_routine GROUP BY ALL"""

VIEWS["v_care"] = """
SELECT a.ADM1_ID, sum(CASE WHEN c_acctbal > 4000 THEN 1.0 ELSE 0.0 END) / count(*) AS PCT
FROM customer JOIN v_admin a ON a.ADM2_ID = 'D' || c_nationkey GROUP BY 1"""

VIEWS["v_survey"] = """
SELECT c_custkey AS CASEID, a.ADM1_NAME, a.ADM1_ID, CAST(floor(abs(c_acctbal)) AS BIGINT) + 1 AS V005,
  CAST(c_custkey % 20 AS INTEGER) AS V021, c_mktsegment AS V023, n_regionkey AS V024,
  coalesce(o.n_orders, 0) AS n_orders, coalesce(o.n_urgent, 0) AS n_urgent, coalesce(o.n_open, 0) AS n_open,
  CAST(floor(abs(c_acctbal)) AS BIGINT) % 97 AS age
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN v_admin a ON a.ADM2_ID = 'D' || c_nationkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders,
    count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
    count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open
  FROM orders GROUP BY 1) o ON o_custkey = c_custkey"""

VIEWS["v_cells"] = """
SELECT vec_id, label, round(CAST(embedding[1] AS DOUBLE), 4) AS lon, round(CAST(embedding[2] AS DOUBLE), 4) AS lat,
  round(abs(CAST(embedding[3] AS DOUBLE)) * 1000, 2) AS value
FROM embeddings"""

VIEWS["v_edges"] = """
SELECT ADM2_ID, 'DS ' || ADM2_ID AS ADM2_NAME, s.seq,
  CASE s.seq WHEN 1 THEN w WHEN 2 THEN mx WHEN 3 THEN e ELSE mx END AS x1,
  CASE s.seq WHEN 1 THEN my WHEN 2 THEN n WHEN 3 THEN my ELSE so END AS y1,
  CASE s.seq WHEN 1 THEN mx WHEN 2 THEN e WHEN 3 THEN mx ELSE w END AS x2,
  CASE s.seq WHEN 1 THEN n WHEN 2 THEN my WHEN 3 THEN so ELSE my END AS y2
FROM (SELECT 'L' || label AS ADM2_ID, min(lon) AS w, max(lon) AS e, min(lat) AS so, max(lat) AS n,
        (min(lon) + max(lon)) / 2 + label * 0.001 AS mx, (min(lat) + max(lat)) / 2 AS my
      FROM v_cells GROUP BY label) CROSS JOIN (VALUES (1), (2), (3), (4)) s(seq)"""

VIEWS["v_climate"] = """
SELECT 'D' || (user_id % 25) AS ADM2_ID, user_id * 1.0 AS lon, 0.0 AS lat, date_trunc('hour', ts) AS ts,
  max(value) AS value
FROM events GROUP BY 1, 2, 3, 4"""

VIEWS["v_district_month"] = """
SELECT ADM2_ID, YEAR, MONTH, PERIOD, sum(CONF) AS CONF,
  sum(CASE WHEN MONTH BETWEEN 6 AND 9 THEN 8 * CONF ELSE CONF END) AS RAIN
FROM v_routine GROUP BY ALL"""


def _sum_where(value, cond):
    return F.sum(F.when(cond, value))


class Tables:
    """The stand-ins of one scale-factor directory; every property is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw_table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def admin(self) -> DataFrame:
        n, r = self.raw_table("nation"), self.raw_table("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.concat(F.lit("R"), "r_regionkey").alias("ADM1_ID"), F.col("r_name").alias("ADM1_NAME"),
            F.concat(F.lit("D"), "n_nationkey").alias("ADM2_ID"), F.col("n_name").alias("ADM2_NAME"))

    @cached_property
    def pyramid(self) -> DataFrame:
        bal = F.col("s_acctbal")
        days = F.floor(bal).cast("int")
        s = self.raw_table("supplier").select(
            F.concat(F.lit("F"), "s_suppkey").alias("OU_ID"),
            F.when(bal > 9000, F.concat("s_name", F.lit(" FERMEE"))).otherwise(F.col("s_name")).alias("OU_NAME"),
            F.concat(F.lit("D"), "s_nationkey").alias("ADM2_ID"),
            F.when(bal >= 0, F.date_add(F.lit("1994-01-01").cast("date"), days % 1500)).alias("OPENING_DATE"),
            F.when(bal > 5000, F.date_add(F.lit("1997-01-01").cast("date"), days % 2500)).alias("CLOSED_DATE"))
        return s.join(self.admin, "ADM2_ID").select(
            "OU_ID", "OU_NAME", "ADM1_ID", "ADM1_NAME", "ADM2_ID", "ADM2_NAME", "OPENING_DATE", "CLOSED_DATE")

    @cached_property
    def facts(self) -> DataFrame:
        flag, disc, qty, line = (F.col(c) for c in ("l_returnflag", "l_discount", "l_quantity", "l_linenumber"))
        ship = F.col("l_shipdate")
        return self.raw_table("lineitem").groupBy(
            F.concat(F.lit("F"), "l_suppkey").alias("OU_ID"),
            (F.year(ship) * 100 + F.month(ship)).cast("int").alias("PERIOD"),
        ).agg(
            _sum_where(qty, flag == "A").alias("SUSP"),
            _sum_where(qty, flag == "R").alias("TEST"),
            _sum_where(F.floor(qty / 2), (flag == "R") & (disc < 0.08)).cast("double").alias("CONF"),
            _sum_where(qty, (flag == "N") & (F.col("l_linestatus") == "F")).alias("PRES"),
            (_sum_where(line, (flag == "R") & (disc < 0.055)) * 3.0).alias("MALTREAT"),
            _sum_where(qty, (flag == "A") & (disc >= 0.045)).alias("MALADM"),
            (_sum_where(line, (flag == "A") & (disc >= 0.075)) * 1.0).alias("MALDTH"),
            _sum_where(qty, disc >= 0.035).alias("ALLADM"),
            (_sum_where(line, disc >= 0.055) * 1.0).alias("ALLDTH"),
            F.sum(qty).alias("ALLOUT"),
        )

    @cached_property
    def routine(self) -> DataFrame:
        p = F.col("PERIOD")
        return self.facts.join(self.pyramid.drop("OPENING_DATE", "CLOSED_DATE"), "OU_ID").select(
            "PERIOD", (p / 100).cast("int").alias("YEAR"), (p % 100).alias("MONTH"),
            "ADM1_ID", "ADM1_NAME", "ADM2_ID", "ADM2_NAME", "OU_ID", "OU_NAME", *INDICATORS, *CARE)

    @cached_property
    def staged_routine(self) -> DataFrame:
        """The routine table written once, for jobs that read it several times."""
        return stage(self.routine)

    def use_staged_routine(self) -> None:
        """Let everything derived from the routine table read the written one."""
        self.routine = self.staged_routine

    @cached_property
    def long(self) -> DataFrame:
        return routine_long(self.routine, INDICATORS)

    @cached_property
    def raw(self) -> DataFrame:
        ship = F.col("l_shipdate")
        sums = self.raw_table("lineitem").groupBy(
            F.col("l_returnflag").alias("DX"), F.col("l_linestatus").alias("CO"),
            F.concat(F.lit("F"), "l_suppkey").alias("OU"),
            (F.year(ship) * 100 + F.month(ship)).cast("string").alias("PE"),
        ).agg(F.sum("l_quantity").alias("q"))
        text = F.concat(F.col("q").cast("bigint").cast("string"), F.lit(".5"))
        value = F.when(F.col("q") == 13, F.lit("n/a")).when(F.col("q") != 17, text)
        return sums.select("DX", "CO", "OU", "PE", value.alias("VALUE"))

    @cached_property
    def dup(self) -> DataFrame:
        ship = F.col("l_shipdate")
        return self.raw_table("lineitem").select(
            F.concat(F.lit("F"), "l_suppkey").alias("OU_ID"),
            (F.year(ship) * 100 + F.month(ship)).cast("int").alias("PERIOD"),
            F.col("l_returnflag").alias("INDICATOR"), F.col("l_quantity").alias("VALUE"),
            "l_orderkey", "l_linenumber", "l_extendedprice")

    @cached_property
    def customer_orders(self) -> DataFrame:
        c, o = self.raw_table("customer"), self.raw_table("orders")
        return o.join(c, o.o_custkey == c.c_custkey)

    @cached_property
    def population(self) -> DataFrame:
        counts = self.customer_orders.groupBy(
            F.concat(F.lit("D"), "c_nationkey").alias("ADM2_ID"), F.year("o_orderdate").alias("YEAR")
        ).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_fin"))
        return counts.join(self.admin, "ADM2_ID").select(
            "ADM1_ID", "ADM1_NAME", "ADM2_ID", "ADM2_NAME", "YEAR", (F.col("n") * 10.0).alias("POPULATION"),
            (F.col("n_fin") * 2.0).alias("POP_UNDER_5"))

    @cached_property
    def reports(self) -> DataFrame:
        day = F.col("o_orderdate")
        top = self.customer_orders.groupBy(
            (F.year(day) * 100 + F.month(day)).cast("int").alias("PERIOD"),
            F.concat(F.lit("C"), "o_custkey").alias("OU_ID"), F.concat(F.lit("D"), "c_nationkey").alias("ADM2_ID"),
            F.col("o_orderstatus").alias("PRODUCT_UID"),
        ).agg(F.max("o_totalprice").alias("top"))
        actual = F.when(F.col("top") > 150000, 1.0).otherwise(0.0)
        both = F.array(F.struct(F.lit("ACTUAL_REPORTS").alias("m"), actual.alias("v")),
                       F.struct(F.lit("EXPECTED_REPORTS").alias("m"), F.lit(1.0).alias("v")))
        p = F.col("PERIOD")
        return top.withColumn("_r", F.explode(both)).select(
            "PERIOD", (p / 100).cast("int").alias("YEAR"), (p % 100).alias("MONTH"), "OU_ID", "ADM2_ID",
            "PRODUCT_UID", F.col("_r.m").alias("PRODUCT_METRIC"), F.col("_r.v").alias("VALUE"))

    @cached_property
    def rate(self) -> DataFrame:
        return self.routine.groupBy("ADM2_ID", "YEAR", "MONTH").agg(
            (F.count("CONF") / F.count(F.lit(1))).alias("REPORTING_RATE"))

    @cached_property
    def care(self) -> DataFrame:
        c = self.raw_table("customer").withColumn("ADM2_ID", F.concat(F.lit("D"), "c_nationkey"))
        return c.join(self.admin, "ADM2_ID").groupBy("ADM1_ID").agg(
            (F.count_if(F.col("c_acctbal") > 4000) / F.count(F.lit(1))).alias("PCT"))

    @cached_property
    def survey(self) -> DataFrame:
        o = self.raw_table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
            F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))
        c = self.raw_table("customer").withColumn("ADM2_ID", F.concat(F.lit("D"), "c_nationkey"))
        whole = F.floor(F.abs("c_acctbal"))
        df = c.join(self.admin, "ADM2_ID").join(o, "c_custkey", "left").select(
            F.col("c_custkey").alias("CASEID"), "ADM1_NAME", "ADM1_ID", (whole + 1).alias("V005"),
            (F.col("c_custkey") % 20).cast("int").alias("V021"), F.col("c_mktsegment").alias("V023"),
            F.substring("ADM1_ID", 2, 5).cast("int").alias("V024"),
            *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_orders", "n_urgent", "n_open")],
            (whole % 97).alias("age"))
        return df

    @cached_property
    def cells(self) -> DataFrame:
        e = self.raw_table("embeddings")
        dim = [F.get("embedding", F.lit(i)).cast("double") for i in range(3)]
        return e.select("vec_id", "label", F.round(dim[0], 4).alias("lon"), F.round(dim[1], 4).alias("lat"),
                        F.round(F.abs(dim[2]) * 1000, 2).alias("value"))

    @cached_property
    def edges(self) -> DataFrame:
        box = self.cells.groupBy("label").agg(
            F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))
        box = box.withColumns({"mx": (F.col("w") + F.col("e")) / 2 + F.col("label") * 0.001,
                               "my": (F.col("s") + F.col("n")) / 2})
        corners = [("w", "my", "mx", "n"), ("mx", "n", "e", "my"), ("e", "my", "mx", "s"), ("mx", "s", "w", "my")]
        rows = F.array(*[
            F.struct(F.lit(i).alias("seq"), *[F.col(c).alias(k) for c, k in zip(corner, ("x1", "y1", "x2", "y2"))])
            for i, corner in enumerate(corners, start=1)])
        name = F.concat(F.lit("L"), "label")
        return box.select(name.alias("ADM2_ID"), F.concat(F.lit("DS "), name).alias("ADM2_NAME"),
                          F.explode(rows).alias("r")).select("ADM2_ID", "ADM2_NAME", "r.*")

    @cached_property
    def district_cells(self) -> DataFrame:
        """The cell to district table, located once and written."""
        return stage(district_cells(self.cells, self.edges, SIZE))

    @cached_property
    def climate(self) -> DataFrame:
        return self.raw_table("events").groupBy(
            F.concat(F.lit("D"), F.col("user_id") % 25).alias("ADM2_ID"), (F.col("user_id") * 1.0).alias("lon"),
            F.lit(0.0).alias("lat"), F.date_trunc("hour", "ts").alias("ts"),
        ).agg(F.max("value").alias("value"))

    @cached_property
    def district_month(self) -> DataFrame:
        wet = F.when(F.col("MONTH").between(6, 9), 8 * F.col("CONF")).otherwise(F.col("CONF"))
        return self.routine.groupBy("ADM2_ID", "YEAR", "MONTH", "PERIOD").agg(
            F.sum("CONF").alias("CONF"), F.sum(wet).alias("RAIN"))
