"""Registry of runnable queries and the SQL each result is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The transactions view in SQL, over the same star schema.
TX = """
tx as (
  select o_custkey as customer_id, p_brand as product_id, l_partkey as part_id,
         l_orderkey as order_id, l_quantity as quantity, l_extendedprice as price,
         o_orderdate as transaction_date, o_orderpriority as payment_method,
         n_name as store_location, p_type as product_category,
         l_discount * 100 as discount_pct,
         l_quantity * l_extendedprice * (1 - l_discount) as total_amount,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as row_key
  from lineitem
  join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
)
"""


def hash32_sql(key: str, seed: int) -> str:
    return f"cast(('0x' || substr(md5(cast({key} as varchar) || ':{seed}'), 1, 8)) as bigint)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use ``{tx}`` for the transactions view."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.replace("{tx}", TX.strip()).strip()
        return function

    return register
