"""Lineage over edges that the given tables imply."""

from pyspark.sql import functions as F

from lodeworks.constants import DIRECT_TRANSFORMS, LAYER_ORDER, TRANSFORM_LABELS
from lodeworks.operators import lineage as lin
from lodeworks.queries.registry import query
from lodeworks.queries.roles import sql

# Declared relations: every shipment line says which part and supplier an order draws on.
_RELATIONS = [
    "named_struct('platform', 'dwd', 'table', concat('order_', l_orderkey)) AS downstream",
    "array(named_struct('platform', 'lims', 'table', concat('part_', l_partkey), 'join_key', 'l_partkey'), "
    "named_struct('platform', 'pi_system', 'table', concat('supplier_', l_suppkey), 'join_key', CAST(NULL AS STRING))) AS upstream",
]
EDGES_SQL = (
    "SELECT DISTINCT 'lims.part_' || l_partkey AS src, 'dwd.order_' || l_orderkey AS dst, 'l_partkey' AS join_key FROM lineitem "
    "UNION SELECT DISTINCT 'pi_system.supplier_' || l_suppkey, 'dwd.order_' || l_orderkey, '' FROM lineitem"
)


def declared(t):
    return lin.edges_of(t.lineitem.selectExpr(*_RELATIONS))


@query("lin_edges", EDGES_SQL)
def lin_edges(t):
    return declared(t)


@query(
    "lin_neighbors",
    sql(
        "",
        "SELECT DISTINCT 'upstream' AS side, src AS node FROM e WHERE dst = 'dwd.order_7' UNION ALL SELECT DISTINCT 'downstream', dst FROM e WHERE src = 'lims.part_42'",
        e=EDGES_SQL,
    ),
)
def lin_neighbors(t):
    edges = declared(t)
    up = lin.upstream(edges, "dwd.order_7").select(F.lit("upstream").alias("side"), "node")
    down = lin.downstream(edges, "lims.part_42").select(F.lit("downstream").alias("side"), "node")
    return up.unionByName(down)


GRAPH_SQL = (
    "SELECT 'nation.' || c_nationkey AS src, 'customer.' || c_custkey AS dst FROM customer "
    "UNION SELECT 'customer.' || o_custkey, 'order.' || o_orderkey FROM orders "
    "UNION SELECT 'order.' || l_orderkey, 'part.' || l_partkey FROM lineitem "
    "UNION SELECT 'part.' || l_partkey, 'supplier.' || l_suppkey FROM lineitem "
    "UNION SELECT 'nation.' || s_nationkey, 'supplier.' || s_suppkey FROM supplier"
)


def graph(t):
    """nation -> customer -> order -> part -> supplier, and nation -> supplier directly."""

    def edge(df, a, ka, b, kb):
        return df.select(F.concat(F.lit(f"{a}."), F.col(ka)).alias("src"), F.concat(F.lit(f"{b}."), F.col(kb)).alias("dst"))

    return (
        edge(t.customer, "nation", "c_nationkey", "customer", "c_custkey")
        .unionByName(edge(t.orders, "customer", "o_custkey", "order", "o_orderkey"))
        .unionByName(edge(t.lineitem, "order", "l_orderkey", "part", "l_partkey"))
        .unionByName(edge(t.lineitem, "part", "l_partkey", "supplier", "l_suppkey"))
        .unionByName(edge(t.supplier, "nation", "s_nationkey", "supplier", "s_suppkey"))
    )


def _reach_sql(start: str, a: str, b: str) -> str:
    return (
        f"WITH RECURSIVE g AS ({GRAPH_SQL}), r(node, depth) AS (SELECT {b}, CAST(1 AS INTEGER) FROM g WHERE {a} = '{start}' "
        f"UNION SELECT g.{b}, CAST(r.depth + 1 AS INTEGER) FROM r JOIN g ON g.{a} = r.node) SELECT node, max(depth) AS depth FROM r GROUP BY node"
    )


@query("lin_blast", _reach_sql("nation.3", "src", "dst"))
def lin_blast(t):
    return lin.blast_radius(graph(t), "nation.3")


@query("lin_ancestors", _reach_sql("part.5", "dst", "src"))
def lin_ancestors(t):
    return lin.ancestors(graph(t), "part.5")


_MAPPED = [
    "named_struct('platform', 'dwd', 'table', concat('order_', l_orderkey)) AS downstream",
    "array(named_struct('platform', 'lims', 'table', concat('part_', l_partkey))) AS upstream",
    "array(named_struct('downstream_column', 'amount', 'upstream_column', CASE l_returnflag WHEN 'A' THEN '*' ELSE 'l_extendedprice' END, "
    "'transformation', CASE l_linestatus WHEN 'O' THEN NULL ELSE 'SUM(l_extendedprice)' END), "
    "named_struct('downstream_column', 'month', 'upstream_column', 'l_shipdate', 'transformation', 'SUBSTR(l_shipdate, 1, 7)')) AS mappings",
]


@query(
    "lin_columns",
    "SELECT 'lims.part_' || l_partkey AS src, CASE l_returnflag WHEN 'A' THEN 'ALL_COLUMNS' ELSE 'l_extendedprice' END AS src_column, "
    "'dwd.order_' || l_orderkey AS dst, 'amount' AS dst_column, CASE l_linestatus WHEN 'O' THEN 'IDENTITY' ELSE 'SUM(l_extendedprice)' END AS transform FROM lineitem "
    "UNION ALL SELECT 'lims.part_' || l_partkey, 'l_shipdate', 'dwd.order_' || l_orderkey, 'month', 'SUBSTR(l_shipdate, 1, 7)' FROM lineitem",
)
def lin_columns(t):
    return lin.column_lineage(t.lineitem.selectExpr(*_MAPPED))


@query(
    "lin_verify",
    "SELECT src, dst FROM (SELECT DISTINCT 'part.' || l_partkey AS src, 'supplier.' || l_suppkey AS dst FROM lineitem) EXCEPT "
    "SELECT 'part.' || l_partkey, 'supplier.' || l_suppkey FROM lineitem WHERE l_returnflag <> 'R'",
)
def lin_verify(t):
    edges = t.lineitem.select(
        F.concat(F.lit("part."), "l_partkey").alias("src"), F.concat(F.lit("supplier."), "l_suppkey").alias("dst"), "l_returnflag"
    )
    return lin.missing_edges(edges, edges.where("l_returnflag != 'R'"))


_LAYER_CASE = "CASE split_part(node, '.', 1) " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(LAYER_ORDER)) + f" ELSE {len(LAYER_ORDER)} END"


@query(
    "lin_layer",
    sql(
        "",
        f"SELECT node, CAST({_LAYER_CASE} AS INTEGER) AS layer FROM (SELECT src AS node FROM e UNION SELECT dst FROM e UNION SELECT 'region.' || r_regionkey FROM region)",
        e=EDGES_SQL,
    ),
)
def lin_layer(t):
    edges = declared(t)
    other = t.region.select(F.concat(F.lit("region."), "r_regionkey").alias("node"))
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).unionByName(other)
    return lin.by_layer(nodes.distinct())


_TRANSFORM = (
    "CASE l_linenumber WHEN 1 THEN 'ROUND(AVG(AD), 2)' WHEN 2 THEN 'SUM(NETWR)' WHEN 3 THEN 'COUNT(*)' WHEN 4 THEN 'SUBSTR(ERDAT, 1, 7)' "
    "WHEN 5 THEN '直接映射' WHEN 6 THEN 'max(value)' ELSE 'lookup(x)' END"
)
_FLAGS = ", ".join(
    f"bool_or(regexp_matches(transform, '{p}', 'i')) AS f{i}" for i, (p, _) in enumerate(TRANSFORM_LABELS)
)
_HITS = "list_filter([" + ", ".join(f"CASE WHEN f{i} THEN '{label}' END" for i, (_, label) in enumerate(TRANSFORM_LABELS)) + "], lambda x: x IS NOT NULL)"
_DIRECT = ", ".join(f"'{x}'" for x in DIRECT_TRANSFORMS)


@query(
    "lin_summarize",
    "SELECT dst, CASE WHEN direct THEN '直接映射' WHEN len(hits) = 0 THEN 'ETL加工' WHEN len(hits) <= 3 THEN array_to_string(hits, '+') "
    "ELSE hits[1] || '+' || hits[2] || '+等' || len(hits) || '类' END AS summary FROM (SELECT dst, direct, "
    f"{_HITS} AS hits FROM (SELECT dst, bool_and(trim(transform) IN ({_DIRECT})) AS direct, {_FLAGS} FROM "
    f"(SELECT 'dwd.order_' || l_orderkey AS dst, {_TRANSFORM} AS transform FROM lineitem) GROUP BY dst))",
)
def lin_summarize(t):
    mappings = t.lineitem.select(F.concat(F.lit("dwd.order_"), "l_orderkey").alias("dst"), F.expr(_TRANSFORM).alias("transform"))
    return lin.summarize_transforms(mappings)
