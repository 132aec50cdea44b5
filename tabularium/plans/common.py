"""Shared SQL fragments: the input shapes as common table expressions, and rounding."""

from __future__ import annotations


def fixed_sql(expr: str, digits: int) -> str:
    """SQL twin of ``functions.columns.fixed``."""
    return f"(floor(({expr}) * 1e{digits} + 0.5::DOUBLE) / 1e{digits})"


DEVICES = """devices AS (
  SELECT CAST(round(value * 100) AS BIGINT) AS bytes, date_trunc('second', ts) AS "timestamp",
         event_type AS app, CAST(user_id AS VARCHAR) AS id,
         'antenna_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR)
           AS antenna_id
  FROM events)"""

USERS = """users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         lower(c_name) || '@example.com' AS email,
         CAST(floor(greatest(c_acctbal, 100.0)) AS BIGINT) AS quota
  FROM customer)"""

LISTINGS = """listings AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS id,
         p_brand AS neighbourhood, l_returnflag AS room_type, p_type AS property_type,
         l_extendedprice AS price, CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
         l_linenumber AS bedrooms, l_quantity AS accommodates, l_tax AS extra_people,
         l_discount AS score, l_shipdate AS listed_on,
         CASE WHEN p_brand NOT IN ('Brand#7', 'Brand#13') AND l_partkey % 16 = 0
              THEN CASE WHEN l_partkey % 160 = 0 THEN 0.0::DOUBLE
                        ELSE p_size * 40.0::DOUBLE END END AS square_feet
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

POSTAL_CODES = """postal AS (
  SELECT c_custkey AS id, c_acctbal AS balance,
    CASE c_custkey % 50 WHEN 0 THEN '' WHEN 1 THEN '-' WHEN 2 THEN '28' WHEN 3 THEN '27004'
      WHEN 4 THEN 'Madrid 28004' WHEN 5 THEN '28002' || chr(10) || '28002' WHEN 6 THEN '2804'
      WHEN 7 THEN '2805' WHEN 8 THEN '2815'
      ELSE '28' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') END AS code
  FROM customer)"""

FEATURES = """sizes AS (
  SELECT p_brand AS name, p_size % 6 AS bedrooms, count(*) AS total,
         sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS cents
  FROM part GROUP BY 1, 2),
priced AS (
  SELECT name, CASE WHEN name NOT IN ('Brand#3', 'Brand#11')
    THEN CAST(floor(CAST(sum(cents) AS DOUBLE) / 100.0::DOUBLE / CAST(sum(total) AS DOUBLE) * 100
               + 0.5::DOUBLE) AS DOUBLE) END AS avgprice
  FROM sizes GROUP BY 1)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
