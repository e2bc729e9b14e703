"""Pieces of SQL shared by the checks."""

PART_GAPS = """(SELECT p_partkey, p_name,
  CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS p_brand,
  CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS p_type,
  CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS p_size,
  CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS p_retailprice FROM part)"""

ORDERS_GAPS = """(SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS o_orderpriority,
  o_orderdate FROM orders)"""


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def union_all(parts) -> str:
    return " UNION ALL ".join(parts)
