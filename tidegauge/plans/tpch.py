"""The 22 TPC-H query shapes on the provided tables.

The tables miss some TPC-H columns, so a few predicates use stand-ins (see README); shape and
operators are kept, result compliance with the benchmark is not claimed. ``nation`` and ``region``
have a fixed size (25 and 5 rows) and are the only explicit broadcasts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.money import as_double, money, net_price, rate
from tidegauge.registry import query
from tidegauge.session import table

# SQL text shared by the oracles.
NET = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
GROSS = f"{NET} * (1 + CAST(l_tax AS DECIMAL(4,2)))"
PARTSUPP = """partsupp AS (
  SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey,
         CAST(sum(l_quantity) AS INTEGER) AS ps_availqty,
         CAST(floor(min(l_extendedprice / l_quantity) * 60) / 100 AS DECIMAL(12,2)) AS ps_supplycost
  FROM lineitem GROUP BY l_partkey, l_suppkey)"""


def day(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def between_days(col: str, start: str, end: str) -> Column:
    """start <= col < end, as timestamp literals so that the parquet scan can use them."""
    return (F.col(col) >= F.expr(f"timestamp_ntz '{start}'")) & (F.col(col) < F.expr(f"timestamp_ntz '{end}'"))


def nations(spark: SparkSession, sf: str, prefix: str = "n") -> DataFrame:
    n = table(spark, sf, "nation")
    return F.broadcast(n.select(*[F.col(c).alias(c.replace("n_", f"{prefix}_", 1)) for c in n.columns]))


def nations_of(spark: SparkSession, sf: str, region: str) -> DataFrame:
    r = table(spark, sf, "region").filter(F.col("r_name") == region)
    return F.broadcast(
        table(spark, sf, "nation").join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    )


def partsupp(lines: DataFrame) -> DataFrame:
    """Part/supplier pairs seen in the lines, standing in for the absent partsupp table.

    Callers pass lines already reduced to the wanted parts or suppliers.
    """
    cost = F.floor(F.min(F.col("l_extendedprice") / F.col("l_quantity")) * 60) / 100
    return lines.groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).agg(
        F.sum("l_quantity").cast("int").alias("ps_availqty"),
        cost.cast("decimal(12,2)").alias("ps_supplycost"),
    )


@query(
    "T1",
    f"""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_base_price,
        CAST(sum({NET}) AS DOUBLE) AS sum_disc_price, CAST(sum({GROSS}) AS DOUBLE) AS sum_charge,
        sum(l_quantity) / count(*) AS avg_qty,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_price,
        CAST(sum(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / count(*) AS avg_disc, count(*) AS count_order
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2 ORDER BY 1, 2""",
)
def t1(spark: SparkSession, sf: str) -> DataFrame:
    # Discounts and taxes take few values: prices are added up per value first, so that the exact
    # products are taken of a few hundred sums instead of every line.
    sums = (
        table(spark, sf, "lineitem")
        .filter(F.col("l_shipdate") <= F.expr("timestamp_ntz '1998-09-02'"))
        .groupBy("l_returnflag", "l_linestatus", rate("l_discount").alias("discount"), rate("l_tax").alias("tax"))
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.sum(money("l_extendedprice")).alias("price"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    one = F.lit(Decimal("1.00"))
    net = F.col("price") * (one - F.col("discount"))
    n, price = F.sum("n"), as_double(F.sum("price"))
    return (
        sums.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("qty").alias("sum_qty"),
            price.alias("sum_base_price"),
            as_double(F.sum(net)).alias("sum_disc_price"),
            as_double(F.sum(net * (one + F.col("tax")))).alias("sum_charge"),
            (F.sum("qty") / n).alias("avg_qty"),
            (price / n).alias("avg_price"),
            (as_double(F.sum(F.col("discount") * F.col("n"))) / n).alias("avg_disc"),
            n.alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


@query(
    "T2",
    f"""WITH {PARTSUPP}, eu AS (
        SELECT ps_partkey, ps_suppkey, ps_supplycost, s_acctbal, s_name, n_name FROM partsupp
        JOIN supplier ON s_suppkey = ps_suppkey JOIN nation ON n_nationkey = s_nationkey
        JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'EUROPE')
    SELECT s_acctbal, s_name, n_name, p_partkey, p_brand FROM part p JOIN eu ON p_partkey = ps_partkey
    WHERE p_size = 15 AND p_type LIKE 'ECONOMY%'
      AND ps_supplycost = (SELECT min(ps_supplycost) FROM eu e2 WHERE e2.ps_partkey = p.p_partkey)
    ORDER BY s_acctbal DESC, n_name, s_name, p_partkey LIMIT 100""",
)
def t2(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").filter((F.col("p_size") == 15) & F.col("p_type").like("ECONOMY%"))
    part = part.select("p_partkey", "p_brand")
    supp = table(spark, sf, "supplier").join(
        nations_of(spark, sf, "EUROPE"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    lines = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    offers = (
        partsupp(lines)
        .join(part, F.col("ps_partkey") == F.col("p_partkey"))
        .join(supp, F.col("ps_suppkey") == F.col("s_suppkey"))
    )
    cheapest = offers.groupBy(F.col("p_partkey").alias("k")).agg(F.min("ps_supplycost").alias("least"))
    return (
        offers.join(cheapest, (F.col("p_partkey") == F.col("k")) & (F.col("ps_supplycost") == F.col("least")))
        .select("s_acctbal", "s_name", "n_name", "p_partkey", "p_brand")
        .orderBy(F.desc("s_acctbal"), "n_name", "s_name", "p_partkey")
        .limit(100)
    )


@query(
    "T3",
    f"""SELECT l_orderkey, CAST(sum({NET}) AS DOUBLE) AS revenue, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_mktsegment = 'BUILDING' AND o_orderdate < TIMESTAMP '1998-03-15' AND l_shipdate > TIMESTAMP '1998-03-15'
    GROUP BY l_orderkey, o_orderdate ORDER BY revenue DESC, o_orderdate, l_orderkey LIMIT 10""",
)
def t3(spark: SparkSession, sf: str) -> DataFrame:
    cut = F.expr("timestamp_ntz '1998-03-15'")
    customers = table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    orders = table(spark, sf, "orders").filter(F.col("o_orderdate") < cut)
    lines = table(spark, sf, "lineitem").filter(F.col("l_shipdate") > cut)
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("l_orderkey", "o_orderdate")
        .agg(as_double(F.sum(net_price())).alias("revenue"))
        .orderBy(F.desc("revenue"), "o_orderdate", "l_orderkey")
        .limit(10)
        .select("l_orderkey", "revenue", day("o_orderdate").alias("o_orderdate"))
    )


@query(
    "T4",
    """SELECT o_orderpriority, count(*) AS order_count FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-07-01' AND o_orderdate < TIMESTAMP '1996-10-01'
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL 60 DAY)
    GROUP BY 1 ORDER BY 1""",
)
def t4(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(between_days("o_orderdate", "1996-07-01", "1996-10-01"))
    late = (F.col("l_orderkey") == F.col("o_orderkey")) & F.expr("l_shipdate > o_orderdate + interval 60 days")
    return (
        orders.join(table(spark, sf, "lineitem"), late, "left_semi")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .orderBy("o_orderpriority")
    )


@query(
    "T5",
    f"""SELECT n_name, CAST(sum({NET}) AS DOUBLE) AS revenue FROM customer
    JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    GROUP BY n_name ORDER BY revenue DESC, n_name""",
)
def t5(spark: SparkSession, sf: str) -> DataFrame:
    supp = table(spark, sf, "supplier").join(
        nations_of(spark, sf, "ASIA"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf, "orders").filter(between_days("o_orderdate", "1997-01-01", "1998-01-01"))
    buyers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (
        orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        .join(supp, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .groupBy("n_name")
        .agg(as_double(F.sum(net_price())).alias("revenue"))
        .orderBy(F.desc("revenue"), "n_name")
    )


@query(
    "T6",
    """SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS revenue
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
      AND l_discount >= 0.05 AND l_discount <= 0.07 AND l_quantity < 24""",
)
def t6(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .filter(between_days("l_shipdate", "1996-01-01", "1997-01-01"))
        .filter(F.col("l_discount").between(0.05, 0.07) & (F.col("l_quantity") < 24))
        .agg(as_double(F.sum(money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"))).alias("revenue"))
    )


@query(
    "T7",
    f"""SELECT n1.n_name AS supp_nation, n2.n_name AS cust_nation, CAST(year(l_shipdate) AS INTEGER) AS l_year,
        CAST(sum({NET}) AS DOUBLE) AS revenue
    FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nation n1 ON s_nationkey = n1.n_nationkey
    JOIN nation n2 ON c_nationkey = n2.n_nationkey
    WHERE ((n1.n_name = 'NATION_1' AND n2.n_name = 'NATION_2') OR (n1.n_name = 'NATION_2' AND n2.n_name = 'NATION_1'))
      AND l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
    GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
)
def t7(spark: SparkSession, sf: str) -> DataFrame:
    pair = ["NATION_1", "NATION_2"]
    n1 = nations(spark, sf, "n1").filter(F.col("n1_name").isin(pair))
    n2 = nations(spark, sf, "n2").filter(F.col("n2_name").isin(pair))
    supp = table(spark, sf, "supplier").join(F.broadcast(n1), F.col("s_nationkey") == F.col("n1_nationkey"))
    cust = table(spark, sf, "customer").join(F.broadcast(n2), F.col("c_nationkey") == F.col("n2_nationkey"))
    buyers = table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, sf, "lineitem")
        .filter(between_days("l_shipdate", "1995-01-01", "1997-01-01"))
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter(F.col("n1_name") != F.col("n2_name"))
        .groupBy(
            F.col("n1_name").alias("supp_nation"),
            F.col("n2_name").alias("cust_nation"),
            F.year("l_shipdate").alias("l_year"),
        )
        .agg(as_double(F.sum(net_price())).alias("revenue"))
        .orderBy("supp_nation", "cust_nation", "l_year")
    )


@query(
    "T8",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year,
        CAST(sum(CASE WHEN n2.n_name = 'NATION_1' THEN {NET} ELSE 0 END) AS DOUBLE) / CAST(sum({NET}) AS DOUBLE) AS mkt_share
    FROM part JOIN lineitem ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation n1 ON c_nationkey = n1.n_nationkey JOIN region ON n1.n_regionkey = r_regionkey
    JOIN nation n2 ON s_nationkey = n2.n_nationkey
    WHERE r_name = 'AMERICA' AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
      AND p_type = 'ECONOMY' GROUP BY 1 ORDER BY 1""",
)
def t8(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").filter(F.col("p_type") == "ECONOMY").select("p_partkey")
    buyers = table(spark, sf, "customer").join(
        nations_of(spark, sf, "AMERICA"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    orders = (
        table(spark, sf, "orders")
        .filter(between_days("o_orderdate", "1995-01-01", "1997-01-01"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    )
    supp = table(spark, sf, "supplier").join(nations(spark, sf, "n2"), F.col("s_nationkey") == F.col("n2_nationkey"))
    ours = F.when(F.col("n2_name") == "NATION_1", net_price()).otherwise(F.lit(0).cast("decimal(18,4)"))
    return (
        table(spark, sf, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.year("o_orderdate").alias("o_year"))
        .agg((as_double(F.sum(ours)) / as_double(F.sum(net_price()))).alias("mkt_share"))
        .orderBy("o_year")
    )


@query(
    "T9",
    f"""WITH {PARTSUPP}
    SELECT n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS o_year,
        CAST(sum({NET} - ps_supplycost * CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_profit
    FROM part JOIN lineitem ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN partsupp ON ps_suppkey = l_suppkey AND ps_partkey = l_partkey
    JOIN orders ON o_orderkey = l_orderkey JOIN nation ON s_nationkey = n_nationkey
    WHERE p_name LIKE '%red%' GROUP BY 1, 2 ORDER BY 1, 2 DESC""",
)
def t9(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").filter(F.col("p_name").contains("red")).select("p_partkey")
    supp = table(spark, sf, "supplier").join(nations(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    lines = table(spark, sf, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    offers = partsupp(lines)
    profit = net_price() - F.col("ps_supplycost") * F.col("l_quantity").cast("decimal(12,2)")
    return (
        lines.join(
            offers, (F.col("l_partkey") == F.col("ps_partkey")) & (F.col("l_suppkey") == F.col("ps_suppkey"))
        )
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("n_name").alias("nation"), F.year("o_orderdate").alias("o_year"))
        .agg(as_double(F.sum(profit)).alias("sum_profit"))
        .orderBy("nation", F.desc("o_year"))
    )


@query(
    "T10",
    f"""SELECT c_custkey, c_name, CAST(sum({NET}) AS DOUBLE) AS revenue, c_acctbal, n_name
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
    JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderdate >= TIMESTAMP '1996-10-01' AND o_orderdate < TIMESTAMP '1997-01-01' AND l_returnflag = 'R'
    GROUP BY c_custkey, c_name, c_acctbal, n_name ORDER BY revenue DESC, c_custkey LIMIT 20""",
)
def t10(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").filter(between_days("o_orderdate", "1996-10-01", "1997-01-01"))
    returned = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    # Sum per customer key first; names and nation are looked up for the summed rows only.
    revenue = (
        orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey")
        .agg(as_double(F.sum(net_price())).alias("revenue"))
    )
    return (
        revenue.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "revenue", "c_acctbal", "n_name")
        .orderBy(F.desc("revenue"), "c_custkey")
        .limit(20)
    )


@query(
    "T11",
    f"""WITH {PARTSUPP}, held AS (
        SELECT ps_partkey, sum(ps_supplycost * ps_availqty) AS v FROM partsupp
        JOIN supplier ON ps_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        WHERE n_name = 'NATION_7' GROUP BY ps_partkey)
    SELECT ps_partkey, CAST(v AS DOUBLE) AS value FROM held
    WHERE v > (SELECT sum(v) * 0.0001 FROM held) ORDER BY value DESC, ps_partkey""",
)
def t11(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.broadcast(table(spark, sf, "nation").filter(F.col("n_name") == "NATION_7"))
    supp = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    lines = table(spark, sf, "lineitem").join(supp, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    held = (
        partsupp(lines)
        .groupBy("ps_partkey")
        .agg(F.sum(F.col("ps_supplycost") * F.col("ps_availqty")).alias("v"))
    )
    bar = held.agg((F.sum("v") * F.expr("0.0001")).alias("bar"))
    return (
        held.filter(F.col("v") > bar.scalar())
        .select("ps_partkey", as_double(F.col("v")).alias("value"))
        .orderBy(F.desc("value"), "ps_partkey")
    )


@query(
    "T12",
    """SELECT l_returnflag,
        CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS BIGINT) AS high_line_count,
        CAST(sum(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS BIGINT) AS low_line_count
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_returnflag IN ('A', 'R') AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
      AND o_orderdate < l_shipdate GROUP BY 1 ORDER BY 1""",
)
def t12(spark: SparkSession, sf: str) -> DataFrame:
    high = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    lines = (
        table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag").isin("A", "R"))
        .filter(between_days("l_shipdate", "1996-01-01", "1997-01-01"))
    )
    return (
        lines.join(
            table(spark, sf, "orders"),
            (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("o_orderdate") < F.col("l_shipdate")),
        )
        .groupBy("l_returnflag")
        .agg(F.count_if(high).alias("high_line_count"), F.count_if(~high).alias("low_line_count"))
        .orderBy("l_returnflag")
    )


@query(
    "T13",
    """SELECT c_count, count(*) AS custdist FROM (
        SELECT c_custkey, count(o_orderkey) AS c_count FROM customer
        LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority <> '1-URGENT' GROUP BY c_custkey)
    GROUP BY c_count ORDER BY custdist DESC, c_count DESC""",
)
def t13(spark: SparkSession, sf: str) -> DataFrame:
    # Counting per customer before the outer join shuffles one row per customer instead of every order.
    per_customer = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderpriority") != "1-URGENT")
        .groupBy("o_custkey")
        .agg(F.count("o_orderkey").alias("n"))
    )
    return (
        table(spark, sf, "customer")
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy(F.coalesce("n", F.lit(0)).alias("c_count"))
        .agg(F.count(F.lit(1)).alias("custdist"))
        .orderBy(F.desc("custdist"), F.desc("c_count"))
    )


@query(
    "T14",
    f"""SELECT 100.0 * CAST(sum(CASE WHEN p_type LIKE 'PROMO%' THEN {NET} ELSE 0 END) AS DOUBLE)
        / CAST(sum({NET}) AS DOUBLE) AS promo_revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_shipdate >= TIMESTAMP '1995-09-01' AND l_shipdate < TIMESTAMP '1995-10-01'""",
)
def t14(spark: SparkSession, sf: str) -> DataFrame:
    promo = F.when(F.col("p_type").like("PROMO%"), net_price()).otherwise(F.lit(0).cast("decimal(18,4)"))
    return (
        table(spark, sf, "lineitem")
        .filter(between_days("l_shipdate", "1995-09-01", "1995-10-01"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .agg((F.lit(100.0) * as_double(F.sum(promo)) / as_double(F.sum(net_price()))).alias("promo_revenue"))
    )


@query(
    "T15",
    f"""WITH revenue AS (SELECT l_suppkey AS supplier_no, sum({NET}) AS total_revenue FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-04-01' GROUP BY 1)
    SELECT s_suppkey, s_name, CAST(total_revenue AS DOUBLE) AS total_revenue FROM supplier
    JOIN revenue ON s_suppkey = supplier_no WHERE total_revenue = (SELECT max(total_revenue) FROM revenue)
    ORDER BY s_suppkey""",
)
def t15(spark: SparkSession, sf: str) -> DataFrame:
    revenue = (
        table(spark, sf, "lineitem")
        .filter(between_days("l_shipdate", "1996-01-01", "1996-04-01"))
        .groupBy("l_suppkey")
        .agg(F.sum(net_price()).alias("total"))
    )
    best = revenue.agg(F.max("total").alias("best"))
    return (
        revenue.filter(F.col("total") == best.scalar())
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("s_suppkey", "s_name", as_double(F.col("total")).alias("total_revenue"))
        .orderBy("s_suppkey")
    )


@query(
    "T16",
    """SELECT p_brand, p_type, p_size, count(DISTINCT l_suppkey) AS supplier_cnt
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE p_brand <> 'Brand#4' AND p_type NOT LIKE 'MEDIUM%' AND p_size IN (49, 14, 23, 45, 19, 3, 36, 9)
      AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
    GROUP BY 1, 2, 3 ORDER BY supplier_cnt DESC, p_brand, p_type, p_size""",
)
def t16(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").filter(
        (F.col("p_brand") != "Brand#4")
        & ~F.col("p_type").like("MEDIUM%")
        & F.col("p_size").isin(49, 14, 23, 45, 19, 3, 36, 9)
    )
    # Supplier keys are never null, so NOT IN is a plain anti join.
    rejected = table(spark, sf, "supplier").filter(F.col("s_acctbal") < 0)
    return (
        table(spark, sf, "lineitem")
        .select("l_partkey", "l_suppkey")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(rejected, F.col("l_suppkey") == F.col("s_suppkey"), "left_anti")
        .groupBy("p_brand", "p_type", "p_size")
        .agg(F.count_distinct("l_suppkey").alias("supplier_cnt"))
        .orderBy(F.desc("supplier_cnt"), "p_brand", "p_type", "p_size")
    )


@query(
    "T17",
    """SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / 7.0 AS avg_yearly
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand = 'Brand#23'
      AND l_quantity * 5 < (SELECT avg(l2.l_quantity) FROM lineitem l2 WHERE l2.l_partkey = p_partkey)""",
)
def t17(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").filter(F.col("p_brand") == "Brand#23").select("p_partkey")
    lines = table(spark, sf, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    usual = lines.groupBy(F.col("l_partkey").alias("k")).agg(
        (F.sum("l_quantity") / F.count(F.lit(1))).alias("avg_quantity")
    )
    return (
        lines.join(usual, (F.col("l_partkey") == F.col("k")) & (F.col("l_quantity") * 5 < F.col("avg_quantity")))
        .agg((as_double(F.sum(money("l_extendedprice"))) / 7.0).alias("avg_yearly"))
    )


@query(
    "T18",
    """SELECT c_name, c_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice,
        sum(l_quantity) AS sum_quantity
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 300)
    GROUP BY c_name, c_custkey, o_orderkey, orders.o_orderdate, o_totalprice
    ORDER BY o_totalprice DESC, orders.o_orderdate, o_orderkey LIMIT 100""",
)
def t18(spark: SparkSession, sf: str) -> DataFrame:
    # The HAVING subquery already holds the wanted sum per order, so lineitem is read once.
    big = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("sum_quantity"))
        .filter(F.col("sum_quantity") > 300)
    )
    return (
        table(spark, sf, "orders")
        .join(big, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .orderBy(F.desc("o_totalprice"), "o_orderdate", "o_orderkey")
        .limit(100)
        .select(
            "c_name", "c_custkey", "o_orderkey", day("o_orderdate").alias("o_orderdate"), "o_totalprice", "sum_quantity"
        )
    )


@query(
    "T19",
    f"""SELECT CAST(sum({NET}) AS DOUBLE) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE (p_brand = 'Brand#12' AND l_quantity BETWEEN 1 AND 11 AND p_size BETWEEN 1 AND 5)
       OR (p_brand = 'Brand#23' AND l_quantity BETWEEN 10 AND 20 AND p_size BETWEEN 1 AND 10)
       OR (p_brand = 'Brand#3' AND l_quantity BETWEEN 20 AND 30 AND p_size BETWEEN 1 AND 15)""",
)
def t19(spark: SparkSession, sf: str) -> DataFrame:
    def branch(brand: str, low: int, size: int) -> Column:
        return (
            (F.col("p_brand") == brand) & F.col("l_quantity").between(low, low + 10) & F.col("p_size").between(1, size)
        )

    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .filter(branch("Brand#12", 1, 5) | branch("Brand#23", 10, 10) | branch("Brand#3", 20, 15))
        .agg(as_double(F.sum(net_price())).alias("revenue"))
    )


@query(
    "T20",
    f"""WITH {PARTSUPP}
    SELECT s_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE n_name = 'NATION_1' AND s_suppkey IN (
        SELECT ps_suppkey FROM partsupp WHERE ps_partkey IN (SELECT p_partkey FROM part WHERE p_name LIKE 'red%')
        AND ps_availqty > (SELECT 0.5 * sum(l_quantity) FROM lineitem WHERE l_partkey = ps_partkey
            AND l_suppkey = ps_suppkey AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'))
    ORDER BY s_name""",
)
def t20(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").filter(F.col("p_name").startswith("red")).select("p_partkey")
    nation = F.broadcast(table(spark, sf, "nation").filter(F.col("n_name") == "NATION_1"))
    supp = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    lines = (
        table(spark, sf, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    )
    # Available quantity and the year's shipments come from the same grouping here.
    in_year = between_days("l_shipdate", "1997-01-01", "1998-01-01")
    plenty = (
        lines.groupBy("l_partkey", "l_suppkey")
        .agg(
            F.sum("l_quantity").cast("int").alias("ps_availqty"),
            F.sum(F.when(in_year, F.col("l_quantity"))).alias("shipped"),
        )
        .filter(F.col("ps_availqty") > F.lit(0.5) * F.col("shipped"))
    )
    return (
        supp.join(plenty, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
        .select("s_name", "s_suppkey")
        .orderBy("s_name")
    )


@query(
    "T21",
    """WITH l AS (SELECT l_orderkey, l_suppkey, l_shipdate > o_orderdate + INTERVAL 60 DAY AS late FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F')
    SELECT s_name, count(*) AS numwait FROM supplier JOIN l l1 ON s_suppkey = l1.l_suppkey
    JOIN nation ON s_nationkey = n_nationkey WHERE n_name = 'NATION_20' AND l1.late
      AND EXISTS (SELECT 1 FROM l l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
      AND NOT EXISTS (SELECT 1 FROM l l3 WHERE l3.l_orderkey = l1.l_orderkey AND l3.l_suppkey <> l1.l_suppkey AND l3.late)
    GROUP BY s_name ORDER BY numwait DESC, s_name LIMIT 100""",
)
def t21(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.broadcast(table(spark, sf, "nation").filter(F.col("n_name") == "NATION_20"))
    supp = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderdate")
    late = F.expr("l_shipdate > o_orderdate + interval 60 days")
    # "Another supplier exists" and "no other supplier is late" are min/max facts per order: one
    # grouping replaces two self joins of the largest table.
    per_order = (
        table(spark, sf, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("first_supp"),
            F.max("l_suppkey").alias("last_supp"),
            F.min(F.when(late, F.col("l_suppkey"))).alias("first_late"),
            F.max(F.when(late, F.col("l_suppkey"))).alias("last_late"),
            F.count_if(late).alias("late_lines"),
        )
        .filter((F.col("first_supp") != F.col("last_supp")) & (F.col("first_late") == F.col("last_late")))
    )
    return (
        per_order.join(supp, F.col("first_late") == F.col("s_suppkey"))
        .groupBy("s_name")
        .agg(F.sum("late_lines").alias("numwait"))
        .orderBy(F.desc("numwait"), "s_name")
        .limit(100)
    )


@query(
    "T22",
    """WITH c AS (SELECT * FROM customer WHERE c_nationkey IN (1, 3, 7, 11, 13, 17, 23))
    SELECT c_nationkey AS cntrycode, count(*) AS numcust,
        CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS totacctbal FROM c
    WHERE c_acctbal > (SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) / count(*) FROM c WHERE c_acctbal > 0)
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')
    GROUP BY 1 ORDER BY 1""",
)
def t22(spark: SparkSession, sf: str) -> DataFrame:
    chosen = table(spark, sf, "customer").filter(F.col("c_nationkey").isin(1, 3, 7, 11, 13, 17, 23))
    typical = chosen.filter(F.col("c_acctbal") > 0).agg(
        (as_double(F.sum(money("c_acctbal"))) / F.count(F.lit(1))).alias("avg_balance")
    )
    recent = table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.expr("timestamp_ntz '2001-01-01'"))
    return (
        chosen.filter(F.col("c_acctbal") > typical.scalar())
        .join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
        .groupBy(F.col("c_nationkey").alias("cntrycode"))
        .agg(F.count(F.lit(1)).alias("numcust"), as_double(F.sum(money("c_acctbal"))).alias("totacctbal"))
        .orderBy("cntrycode")
    )
