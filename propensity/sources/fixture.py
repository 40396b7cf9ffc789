"""The prospects table derived from the driver's ``orders`` and ``customer`` tables.

One row per order; customer attributes come through an equi-join on the
customer key.  Every column is a deterministic function of the joined row
(plus a keyed draw for ``Response``), so the same table can be rebuilt in any
SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keyed import u
from ..session import spread

# Fixed values of the fixture definition.
VINTAGE_REFERENCE_DATE = "2001-08-02"
RESPONSE_RATE_INSURED = 0.01
RESPONSE_RATE_DAMAGED = 0.30
RESPONSE_RATE_OTHER = 0.06


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(read_input(spark, sf_dir, "orders"), "o_orderkey")
    customer = read_input(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    # No broadcast hint: customer grows with the data.  Catalyst/AQE broadcast
    # it only when its (runtime) size is under autoBroadcastJoinThreshold;
    # otherwise this is a sort-merge join whose skewed partitions (a customer
    # owning a large share of orders) AQE splits.
    j = orders.join(customer, orders.o_custkey == customer.c_custkey)
    c = F.col
    raw = j.select(
        c("o_orderkey").alias("id"),
        F.when(c("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("Gender"),
        (F.lit(20) + c("c_custkey") % 66).cast("int").alias("Age"),
        F.when(c("o_orderkey") % 500 == 0, 0).otherwise(1).alias("Driving_License"),
        c("c_nationkey").cast("double").alias("Region_Code"),
        F.when((c("o_orderstatus") == "F") | (c("c_mktsegment") == "AUTOMOBILE"), 1)
        .otherwise(0).alias("Previously_Insured"),
        F.when(c("o_orderpriority").isin("1-URGENT", "2-HIGH"), "< 1 Year")
        .when(c("o_orderpriority") == "5-LOW", "> 2 Years")
        .otherwise("1-2 Year").alias("Vehicle_Age"),
        F.when(F.floor("o_totalprice").cast("bigint") % 2 == 1, "Yes")
        .otherwise("No").alias("Vehicle_Damage"),
        c("o_totalprice").alias("Annual_Premium"),
        (c("o_custkey") % 160).cast("double").alias("Policy_Sales_Channel"),
        F.datediff(F.lit(VINTAGE_REFERENCE_DATE).cast("date"), c("o_orderdate").cast("date"))
        .cast("int").alias("Vintage"),
    )
    rate = (F.when(c("Previously_Insured") == 1, F.lit(RESPONSE_RATE_INSURED))
            .when(c("Vehicle_Damage") == "Yes", F.lit(RESPONSE_RATE_DAMAGED))
            .otherwise(F.lit(RESPONSE_RATE_OTHER)))
    return raw.withColumn("Response", F.when(u("id", "response") < rate, 1).otherwise(0))
