"""Transaction tables projected from the test tables.

The same text runs on Spark and on DuckDB, and every source table is used whole. Keys that match no
dimension come from the transaction side, and one merchant takes a third of all transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TRANSACTIONS = """
select 'tx_' || cast(event_id as string) as txn_id,
  case when event_id % 97 = 0 then 'not-a-date' when event_id % 89 = 0 then ''
       else substring(cast(ts as string), 1, 19) end as txn_ts,
  case when event_id % 83 = 0 then 'abc' when event_id % 79 = 0 then '' when event_id % 73 = 0 then '0'
       when event_id % 71 = 0 then '-' || cast(cast(value as decimal(12,2)) as string)
       when event_id % 67 = 0 then '25000.50' when event_id % 59 = 0 then '1e3'
       when event_id % 53 = 0 then '99999999999.99'
       else ' ' || cast(cast(value as decimal(12,2)) as string) || ' ' end as amount,
  case when event_id % 61 = 0 then '  ' when event_id % 19 = 0 then 'x_' || cast(user_id as string)
       else 'c_' || cast(user_id as string) end as card_id,
  case when event_id % 17 = 0 then 'mx_' || cast(event_id % 50 as string)
       when event_id % 3 = 0 then 'm_0'
       else 'm_' || cast(user_id + event_id % 40 as string) end as merchant_id,
  case when event_id % 23 = 0 then 'dx_' || cast(event_id % 11 as string)
       else 'd_' || cast(user_id * 2 + event_id % 5 as string) end as device_id,
  case when event_id % 7 = 0 then 'point_of_sale' when event_id % 11 = 0 then 'api'
       else case event_type when 'view' then 'web' when 'click' then ' Online '
                 when 'purchase' then 'APP' when 'signup' then 'kiosk' else null end end as channel,
  case when event_id % 101 = 0 then 'é'
       else case event_id % 5 when 0 then 'IN' when 1 then 'us' when 2 then ' gb '
                 when 3 then 'USA' else null end end as country,
  case event_type when 'error' then 'declined' when 'view' then null when 'signup' then 'PENDING'
       else 'APPROVED' end as auth_result,
  case when event_id % 29 = 0 then 'Yes' when event_id % 31 = 0 then 'maybe'
       when event_id % 37 = 0 then 'TRUE' else '0' end as is_fraud
from events
"""

MERCHANTS = """
select 'm_' || cast(p_partkey as string) as merchant_id, p_name as merchant_name,
  ' ' || cast(p_size as string) as mcc,
  case p_partkey % 3 when 0 then 'IN' when 1 then 'US' else '' end as country,
  case p_partkey % 4 when 0 then 'HIGH' when 1 then ' high ' when 2 then 'LOW' else '' end as risk_tier
from part
"""

DEVICES = """
select 'd_' || cast(p_partkey as string) as device_id, p_type as os, p_brand as browser,
  case p_partkey % 5 when 0 then '1' when 1 then 'False' when 2 then ' true ' when 3 then 'y'
       else '0' end as is_emulator
from part
"""

CARDS = """
select 'c_' || cast(c_custkey as string) as card_id, cast(400000 + c_custkey as string) as bin,
  c_mktsegment as issuer,
  case when c_acctbal < 0 then '' when c_custkey % 2 = 0 then 'DEBIT' else ' CREDIT' end as card_type
from customer
"""

RULE_HITS = """
select 'tx_' || cast(event_id as string) as txn_id, 'rule_' || event_type as rule_name,
  cast(event_id % 100 as string) as rule_score
from events
"""

NOTES = """
select 'tx_' || cast(o_orderkey as string) as txn_id, o_orderpriority as note_text,
  substring(cast(o_orderdate as string), 1, 10) as created_at
from orders
"""

# Typed, multi-year rows for the 30-day windows.
LEDGER = """
select 'tx_' || cast(l.l_orderkey as string) || '_' || cast(l.l_linenumber as string) as txn_id_clean,
  l.l_shipdate as txn_ts, cast(l.l_extendedprice as decimal(12,2)) as amount,
  case when o.o_custkey % 50 = 0 then null else 'c_' || cast(o.o_custkey as string) end as card_id_clean,
  'm_' || cast(l.l_suppkey as string) as merchant_id_clean,
  case when l.l_linenumber = 7 then null else l.l_returnflag = 'R' end as is_fraud,
  o.o_orderstatus = 'F' as is_declined
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    frames = {}
    for name in tables:
        frames[name] = _table(spark, sf_dir, name)
        text = text.replace(f"from {name}", "from {" + name + "}").replace(f"join {name}", "join {" + name + "}")
    return spark.sql(text, **frames)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, RAW_TRANSACTIONS, "events")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, MERCHANTS, "part")


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, DEVICES, "part")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, CARDS, "customer")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, LEDGER, "lineitem", "orders")


def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, RULE_HITS, "events")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, NOTES, "orders")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six raw tables by name."""
    return {
        "raw_transactions": raw_transactions(spark, sf_dir), "raw_merchants": merchants(spark, sf_dir),
        "raw_devices": devices(spark, sf_dir), "raw_cards": cards(spark, sf_dir),
        "raw_rule_hits": rule_hits(spark, sf_dir), "raw_investigator_notes": notes(spark, sf_dir),
    }
