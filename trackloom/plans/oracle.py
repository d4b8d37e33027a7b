"""DuckDB forms of the views in trackloom.sources.tables, for oracle queries."""

POSE = """pose AS (SELECT user_id AS scene, event_id AS eid, epoch_us(ts) AS t, value AS x,
  CAST(event_id * 7919 % 1000 AS DOUBLE) / 10 AS y, event_type AS kind FROM events)"""

POINTS = """points AS (SELECT l_orderkey % 50 AS frame, l_quantity - 25 AS x, l_extendedprice / 1000 - 50 AS y,
  l_discount * 20 + l_tax AS z, l_returnflag || l_linestatus AS cls FROM lineitem)"""

BOXES = """boxes AS (SELECT l_orderkey AS frame, l_partkey * 100 + l_linenumber * 10 + l_suppkey % 10 AS box,
  CAST(l_partkey % 80 - 40 AS DOUBLE) AS x, CAST(l_suppkey % 50 - 25 AS DOUBLE) AS y, l_quantity / 10 AS w,
  l_extendedprice / 10000 AS l, l_discount * 10 AS score, l_returnflag AS cls FROM lineitem)"""
