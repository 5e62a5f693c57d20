"""Subscription tables derived from a retail star schema (customers, orders, events).

The engine works on members, train, transactions, user_logs and predictions. A retail data set has none of them,
so these views map its customers to subscribers, its orders to payments and its events to listening activity.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

LABEL_DATE = "timestamp_ntz'2000-08-01'"
AS_OF = datetime(2024, 1, 31)

# Known layouts spare every read a schema-inference job.
RETAIL_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


@dataclass(frozen=True)
class RetailViews:
    """Lazy views over one folder of parquet tables."""

    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(RETAIL_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def members(self) -> DataFrame:
        return self.read("customer").where("c_custkey % 8 <> 7").selectExpr(
            "cast(c_custkey as string) as msno",
            "cast(c_nationkey as smallint) as city",
            "cast(floor(c_acctbal / 100) as smallint) as bd",
            "case c_custkey % 3 when 0 then 'male' when 1 then 'female' end as gender",
            "cast(case c_mktsegment when 'AUTOMOBILE' then 3 when 'BUILDING' then 4 when 'FURNITURE' then 7 "
            "when 'HOUSEHOLD' then 9 else 13 end as smallint) as registered_via",
            "cast((1990 + c_custkey % 5) * 10000 + (1 + c_custkey % 12) * 100 + 1 + c_custkey % 28 as int) "
            "as registration_init_time",
        )

    @cached_property
    def train(self) -> DataFrame:
        """A customer without an order from the label date on has churned."""
        stayed = self.read("orders").where(f"o_orderdate >= {LABEL_DATE}").selectExpr("cast(o_custkey as string) as msno")
        customers = self.read("customer").selectExpr("cast(c_custkey as string) as msno")
        return customers.join(stayed.distinct().selectExpr("msno", "true as stayed"), "msno", "left").selectExpr(
            "msno", "cast(if(stayed, 0, 1) as smallint) as is_churn"
        )

    @cached_property
    def transactions(self) -> DataFrame:
        orders = self.read("orders").where(f"o_orderdate < {LABEL_DATE} and o_custkey % 50 <> 49").selectExpr(
            "*",
            "to_date(o_orderdate) as day",
            "case o_orderkey % 4 when 0 then 7 when 1 then 30 when 2 then 90 else 195 end as payment_plan_days",
            "cast(floor(o_totalprice) as int) as plan_list_price",
        )
        return orders.selectExpr(
            "o_orderkey as txn_id",
            "cast(o_custkey as string) as msno",
            "cast(cast(substr(o_orderpriority, 1, 1) as int) + 5 * (o_orderkey % 8) as smallint) as payment_method_id",
            "payment_plan_days",
            "plan_list_price",
            "cast(plan_list_price - 10 * (o_orderkey % 3) as int) as actual_amount_paid",
            "cast(o_orderstatus = 'F' as smallint) as is_auto_renew",
            "year(day) * 10000 + month(day) * 100 + dayofmonth(day) as transaction_date",
            "date_add(day, payment_plan_days) as expiry",
            "cast(o_orderstatus = 'P' and o_orderkey % 5 = 0 as smallint) as is_cancel",
        ).selectExpr(
            "* except (expiry, is_cancel)",
            "year(expiry) * 10000 + month(expiry) * 100 + dayofmonth(expiry) as membership_expire_date",
            "is_cancel",
        )

    @cached_property
    def user_logs(self) -> DataFrame:
        days = self.read("events").selectExpr(
            "cast(user_id as string) as msno",
            "year(ts) * 10000 + month(ts) * 100 + dayofmonth(ts) as date",
            "event_type", "get_json_object(props, '$.k') as k", "cast(value as decimal(18,2)) as secs",
        )
        days.createOrReplaceTempView("tenura_event_days")
        return self.spark.sql("""
            select msno, date,
              cast(count_if(event_type = 'view') as int) as num_25,
              cast(count_if(event_type = 'click') as int) as num_50,
              cast(count_if(event_type = 'signup') as int) as num_75,
              cast(count_if(event_type = 'error') as int) as num_985,
              cast(count_if(event_type = 'purchase') as int) as num_100,
              cast(count(distinct k) as int) as num_unq,
              cast(sum(secs) as decimal(18,2)) as total_secs
            from tenura_event_days group by msno, date
        """)

    @cached_property
    def predictions(self) -> DataFrame:
        """Several scored rows per customer; pred_id breaks ties of scored_at."""
        return self.read("events").selectExpr(
            "event_id as pred_id",
            "cast(user_id as string) as customer_id",
            "ts as scored_at",
            "least(cast(round(value * 100) as bigint) div 2, 10000L) / 10000D as churn_probability",
            "concat('v', event_id % 3) as model_version",
            "'v1' as threshold_version",
            "if(event_id % 7 <> 0, concat('snap-', year(ts) * 10000 + month(ts) * 100 + dayofmonth(ts)), null) "
            "as feature_snapshot_id",
        ).selectExpr(
            "*", "case when churn_probability >= 0.7 then 'High' when churn_probability >= 0.4 then 'Medium' else 'Low' end as risk_tier"
        )
