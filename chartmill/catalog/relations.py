"""Joins, group-wise reductions, ordering and top rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.catalog.registry import query
from chartmill.catalog.standins import DICTIONARY_SQL, PATIENTS_SQL, Tables
from chartmill.operators import choose, lookups
from chartmill.plans import reference_data

LINE_ORDER_SQL = """l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
    l_shipdate"""
SITE_SQL = """SELECT c_custkey AS location_id, c_name AS uuid, c_mktsegment || ' ' || c_name AS name,
    c_mktsegment AS description, CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS BIGINT) END AS parent_location
    FROM customer"""


# ---- joins --------------------------------------------------------------------------------------------------


@query("join_star_inner", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_orderdate, c_name, n_name, r_name, p_name, s_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""")
def join_star_inner(t: Tables) -> DataFrame:
    placed = lookups.star_join(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
        (t.customer.select("c_custkey", "c_name", "c_nationkey"), {"o_custkey": "c_custkey"}),
        (t.nation, {"c_nationkey": "n_nationkey"}),
        (t.region, {"n_regionkey": "r_regionkey"}),
    )
    star = lookups.star_join(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"),
        (t.part.select("p_partkey", "p_name"), {"l_partkey": "p_partkey"}),
        (t.supplier.select("s_suppkey", "s_name"), {"l_suppkey": "s_suppkey"}),
        (placed, {"l_orderkey": "o_orderkey"}),
    )
    return star.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "o_orderdate", "c_name",
                       "n_name", "r_name", "p_name", "s_name")


@query("join_person_star", """
    SELECT o_orderkey, c_custkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def join_person_star(t: Tables) -> DataFrame:
    star = lookups.star_join(
        t.orders.select("o_orderkey", "o_custkey"),
        (t.customer.select("c_custkey", "c_name", "c_nationkey"), {"o_custkey": "c_custkey"}),
        (t.nation, {"c_nationkey": "n_nationkey"}),
        (t.region, {"n_regionkey": "r_regionkey"}),
    )
    return star.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "c_name", "n_name", "r_name")


@query("join_on_with_filter", """
    SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey AND c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def join_on_with_filter(t: Tables) -> DataFrame:
    on = (t.orders["o_custkey"] == t.customer["c_custkey"]) & t.customer["c_mktsegment"].isin("BUILDING", "MACHINERY")
    return t.orders.join(t.customer, on).select("o_orderkey", "c_name")


@query("join_using", """
    SELECT encounter_id, l_linenumber, l_partkey, l_quantity, o_orderdate
    FROM (SELECT l_orderkey AS encounter_id, l_linenumber, l_partkey, l_quantity FROM lineitem)
    JOIN (SELECT o_orderkey AS encounter_id, o_orderdate FROM orders) USING (encounter_id)""")
def join_using(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("encounter_id"), "l_linenumber", "l_partkey", "l_quantity")
    return lines.join(t.orders.select(F.col("o_orderkey").alias("encounter_id"), "o_orderdate"), "encounter_id")


@query("join_const_on", """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem
    JOIN part ON l_partkey = p_partkey AND p_type = 'PROMO' AND p_size <= 25""")
def join_const_on(t: Tables) -> DataFrame:
    names = t.part.where((F.col("p_type") == "PROMO") & (F.col("p_size") <= 25)).select("p_partkey", "p_name")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(
        names, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


@query("join_left_agg", """
    SELECT o_orderkey, n_items, last_ship FROM orders LEFT JOIN (
        SELECT l_orderkey, count(*) AS n_items, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey)
      ON o_orderkey = l_orderkey""")
def join_left_agg(t: Tables) -> DataFrame:
    summary = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_items"), F.max("l_shipdate").alias("last_ship"))
    return t.orders.select("o_orderkey").join(summary, "o_orderkey", "left")


@query("semi_in_subquery", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#3', 'Brand#8', 'Brand#21'))""")
def semi_in_subquery(t: Tables) -> DataFrame:
    wanted = t.part.where(F.col("p_brand").isin("Brand#1", "Brand#3", "Brand#8", "Brand#21"))
    return lookups.semi_on(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), wanted, {"l_partkey": "p_partkey"})


@query("semi_hierarchy", f"""
    WITH site AS ({SITE_SQL})
    SELECT location_id, name, description, parent_location FROM site
    WHERE location_id IN (SELECT parent_location FROM site WHERE parent_location IS NOT NULL)""")
def semi_hierarchy(t: Tables) -> DataFrame:
    return reference_data.parent_locations(t.site)


@query("semi_migrated", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def semi_migrated(t: Tables) -> DataFrame:
    return lookups.semi_on(t.orders.select("o_orderkey", "o_custkey"), t.patients, {"o_custkey": "person_id"})


def staged_lines(t: Tables, *columns: str) -> DataFrame:
    """Lineitems that count as loaded: the returned ones."""
    return t.lineitem.where("l_returnflag = 'R'").select(*columns)


@query("anti_not_staged", """
    SELECT DISTINCT l_orderkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def anti_not_staged(t: Tables) -> DataFrame:
    keys = ["l_orderkey"]
    return lookups.new_rows(t.lineitem.select(*keys), staged_lines(t, *keys), keys)


@query("anti_not_staged_two_keys", """
    SELECT l_orderkey, l_linenumber, min(l_shipdate) AS l_shipdate FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.l_returnflag = 'R' AND s.l_orderkey = l.l_orderkey
                        AND s.l_linenumber = l.l_linenumber)
    GROUP BY l_orderkey, l_linenumber""")
def anti_not_staged_two_keys(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return lookups.new_rows(t.lineitem.select(*keys, "l_shipdate"), staged_lines(t, *keys), keys, ["l_shipdate"])


@query("anti_not_staged_three_keys", """
    SELECT l_orderkey, l_linenumber, partkey AS l_partkey, min(l_shipdate) AS l_shipdate
    FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_partkey END AS partkey FROM lineitem) l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.l_returnflag = 'R' AND s.l_orderkey = l.l_orderkey
                        AND s.l_linenumber = l.l_linenumber
                        AND CASE WHEN s.l_linestatus = 'F' THEN s.l_partkey END IS NOT DISTINCT FROM l.partkey)
    GROUP BY l_orderkey, l_linenumber, partkey""")
def anti_not_staged_three_keys(t: Tables) -> DataFrame:
    """The third key is missing on half of the rows, so it is compared with nulls equal."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    part = F.when(F.col("l_linestatus") == "F", F.col("l_partkey"))
    rows = t.lineitem.withColumn("l_partkey", part)
    staged = rows.where("l_returnflag = 'R'").select(*keys)
    return lookups.new_rows(rows.select(*keys, "l_shipdate"), staged, keys, ["l_shipdate"], nullable=["l_partkey"])


@query("lookup_first", """
    SELECT o_orderkey, first_part, first_supplier FROM orders LEFT JOIN (
        SELECT l_orderkey, l_partkey AS first_part, l_suppkey AS first_supplier FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1)
      ON o_orderkey = l_orderkey""")
def lookup_first(t: Tables) -> DataFrame:
    return lookups.lookup_first(t.orders.select("o_orderkey"), t.lineitem, {"o_orderkey": "l_orderkey"},
                                {"l_partkey": "first_part", "l_suppkey": "first_supplier"}, ["l_linenumber"])


@query("join_fanout_dedupe", """
    WITH names AS (SELECT p_partkey, p_name AS name FROM part UNION ALL SELECT p_partkey, p_brand FROM part)
    SELECT l_orderkey, l_linenumber, l_partkey, name AS concept_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN names ON l_partkey = p_partkey
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, name) = 1""")
def join_fanout_dedupe(t: Tables) -> DataFrame:
    """Several names per concept, one kept: names and observations are reduced before they meet."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    single = choose.pick_one(lines, ["l_orderkey", "l_linenumber"])
    kept = lookups.semi_on(single, t.orders, {"l_orderkey": "o_orderkey"})
    return lookups.lookup_first(kept, t.concept_name, {"l_partkey": "concept_id"}, {"name": "concept_name"}, how="inner")


@query("join_staged_concept", f"""
    SELECT encounter_id, concept_id, person_id, target_concept_uuid
    FROM (SELECT l_orderkey AS encounter_id, l_partkey AS concept_id FROM lineitem)
    JOIN (SELECT o_orderkey, o_custkey AS person_id FROM orders) ON encounter_id = o_orderkey
    JOIN ({DICTIONARY_SQL}) ON CAST(concept_id AS VARCHAR) = source_concept_id
    WHERE person_id IN (SELECT person_id FROM ({PATIENTS_SQL}))""")
def join_staged_concept(t: Tables) -> DataFrame:
    """The keyed form of the join that was written without a condition: each observation with its own concept."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("encounter_id"), F.col("l_partkey").alias("concept_id"),
                              F.col("l_partkey").cast("string").alias("_concept"))
    at = lookups.semi_on(t.orders.select("o_orderkey", F.col("o_custkey").alias("person_id")), t.patients,
                         {"person_id": "person_id"})
    codes = t.dictionary.select("source_concept_id", "target_concept_uuid")
    star = lookups.star_join(lines, (codes, {"_concept": "source_concept_id"}), (at, {"encounter_id": "o_orderkey"}))
    return star.drop("_concept")


@query("join_staged_source", """
    SELECT l_orderkey, l_linenumber, l_partkey, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0""")
def join_staged_source(t: Tables) -> DataFrame:
    at = lookups.star_join(t.orders.select("o_orderkey", "o_custkey"),
                           (t.patients.select("person_id", F.col("uuid").alias("c_name")), {"o_custkey": "person_id"}))
    star = lookups.star_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
                             (at.select("o_orderkey", "c_name"), {"l_orderkey": "o_orderkey"}))
    return star


# ---- reductions ---------------------------------------------------------------------------------------------


@query("group_representative", f"""
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1""")
def group_representative(t: Tables) -> DataFrame:
    return choose.pick_one(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


SIGNS = {n: f"sign_{n}" for n in range(1, 8)}
PIVOT_SQL = ", ".join(f"max(CASE WHEN l_linenumber = {n} THEN l_quantity END) AS {name}" for n, name in SIGNS.items())


@query("pivot_vitals", f"""
    SELECT o_custkey, l_orderkey, max(l_shipdate) AS obs_datetime, {PIVOT_SQL}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_orderkey""")
def pivot_vitals(t: Tables) -> DataFrame:
    wide = choose.pivot_measures(t.lineitem, ["l_orderkey"], "l_linenumber", "l_quantity", SIGNS,
                                 [F.max("l_shipdate").alias("obs_datetime")])
    at = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return wide.join(at, "l_orderkey").select("o_custkey", "l_orderkey", "obs_datetime", *SIGNS.values())


@query("agg_min", "SELECT o_custkey, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey")
def agg_min(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"))


@query("agg_concat", """
    SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
    FROM lineitem GROUP BY l_orderkey""")
def agg_concat(t: Tables) -> DataFrame:
    return choose.join_distinct(t.lineitem, ["l_orderkey"], "l_returnflag", "flags")


@query("agg_two_level", """
    WITH first_taken AS (SELECT l_suppkey, l_partkey, min(l_orderkey) AS encounter_id FROM lineitem GROUP BY l_suppkey, l_partkey),
         drugs AS (SELECT DISTINCT encounter_id, l_partkey, p_name FROM first_taken JOIN part ON l_partkey = p_partkey)
    SELECT encounter_id, string_agg(p_name, ',' ORDER BY p_name) AS regimen FROM drugs GROUP BY encounter_id""")
def agg_two_level(t: Tables) -> DataFrame:
    first_taken = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.min("l_orderkey").alias("encounter_id"))
    named = lookups.star_join(first_taken, (t.part.select("p_partkey", "p_name"), {"l_partkey": "p_partkey"}))
    return choose.join_names(named, ["encounter_id"], "l_partkey", "p_name", "regimen")


@query("distinct_rows", "SELECT DISTINCT l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def distinct_rows(t: Tables) -> DataFrame:
    """Keys are made distinct before they are named."""
    keys = t.lineitem.select("l_partkey").distinct()
    return lookups.star_join(keys, (t.part.select("p_partkey", "p_name"), {"l_partkey": "p_partkey"}))


@query("distinct_first_by", """
    SELECT nullif(c_mktsegment, 'FURNITURE') AS parent_name, min(c_custkey) AS c_custkey FROM customer
    WHERE nullif(c_mktsegment, 'FURNITURE') IS NOT NULL GROUP BY 1""")
def distinct_first_by(t: Tables) -> DataFrame:
    named = t.customer.select(F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("parent_name"), "c_custkey")
    return choose.first_by_name(named, "parent_name", ["c_custkey"])


# ---- order and top rows -------------------------------------------------------------------------------------


@query("order_by", "SELECT c_custkey, c_nationkey, c_name FROM customer ORDER BY c_nationkey DESC, lower(c_name)")
def order_by(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_nationkey", "c_name").orderBy(F.desc("c_nationkey"), F.lower("c_name"))


@query("top_n", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def top_n(t: Tables) -> DataFrame:
    return choose.top_n(t.orders.select("o_orderkey", "o_orderdate"), [F.desc("o_orderdate"), "o_orderkey"], 100)


@query("limit_any", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10")
def limit_any(t: Tables) -> DataFrame:
    """Any ten rows were asked for; the lowest keys make it repeatable."""
    return choose.top_n(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], 10)


@query("latest_row", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders ORDER BY o_orderkey DESC LIMIT 1""")
def latest_row(t: Tables) -> DataFrame:
    return choose.latest(t.orders, "o_orderkey")
