"""The given tables in the roles of the five source systems.

A role is a column mapping with defects put in by key arithmetic, written as SQL expressions that
Spark and the checking engine read alike. All rows of the table are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodeworks.operators.cleaning import clean

_DAY = "CAST(CAST({} AS DATE) AS STRING)"
_TAG = (
    "'M00' || CAST(user_id % 5 + 1 AS STRING) || '_FACE_' || substr('ABC', CAST(user_id % 3 + 1 AS INT), 1) || '_' || "
    "CASE event_type WHEN 'error' THEN 'WAGAS' WHEN 'click' THEN 'TEMP' WHEN 'view' THEN 'CO' "
    "WHEN 'signup' THEN 'CO2' ELSE 'PRESS' END"
)
_COAL = (
    "CASE l_returnflag || l_linestatus WHEN 'AF' THEN '原煤' WHEN 'AO' THEN '精煤' WHEN 'NF' THEN '中煤' "
    "WHEN 'NO' THEN '矸石' WHEN 'RF' THEN '洗煤' ELSE '其他' END"
)
_FLOW = (
    "CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN '付款申请' "
    "WHEN o_orderpriority = '2-HIGH' THEN '采购申请' WHEN o_orderpriority = '3-MEDIUM' THEN '合同审批' "
    "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '请假申请' ELSE '出差申请' END"
)

ROLES: dict[str, tuple[str, dict[str, str]]] = {
    "vbak": (
        "orders",
        {
            "VBELN": "CASE WHEN o_orderkey % 200 = 1 THEN o_orderkey - 1 ELSE o_orderkey END",
            "ERDAT": "CASE WHEN o_orderkey % 151 = 0 THEN '00000000' WHEN o_orderkey % 157 = 0 THEN NULL ELSE "
            + _DAY.format("o_orderdate") + " END",
            "ERZET": "CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE '08:00:00' END",
            "ERNAM": "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE 'USER' || CAST(o_custkey % 7 AS STRING) END",
            "AUART": "o_orderpriority",
            "KUNNR": "CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
            "NETWR": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END",
            "BZIRK": "'D00' || CAST(o_custkey % 5 + 1 AS STRING)",
            "VKORG": "o_orderstatus",
            "ROW_NO": "o_orderkey",
        },
    ),
    "vbap": (
        "lineitem",
        {
            "VBELN": "CASE WHEN l_orderkey % 101 = 0 THEN CAST(-1 AS BIGINT) ELSE l_orderkey END",
            "POSNR": "l_linenumber",
            "MATNR": "CASE WHEN l_partkey % 127 = 0 THEN NULL ELSE CAST(501000000 + l_partkey AS STRING) END",
            "KWMENG": "l_quantity",
            "NETWR": "CASE WHEN l_suppkey % 31 = 0 THEN 0.0 - l_extendedprice ELSE l_extendedprice END",
            "CHARG": "'L' || CAST(l_partkey * 7 + l_suppkey AS STRING)",
            "LIFNR": "l_suppkey",
            "EDATU": _DAY.format("l_shipdate"),
        },
    ),
    "kna1": (
        "customer",
        {
            "KUNNR": "CAST(c_custkey AS STRING)",
            "NAME1": "CASE WHEN c_custkey % 79 = 0 THEN NULL WHEN c_custkey % 53 = 0 THEN 'ABC' ELSE c_name END",
            "ORT01": "'N' || CAST(c_nationkey AS STRING)",
            "STCD1": "CASE WHEN c_custkey % 83 = 0 THEN NULL WHEN c_custkey % 10 < 7 THEN "
            "CAST(910000000000000000 + c_custkey AS STRING) ELSE CAST(91000000000000 + c_custkey AS STRING) END",
            "ERDAT": "CASE WHEN c_custkey % 41 = 0 THEN '2009-05-01' WHEN c_custkey % 43 = 0 THEN 'unknown' ELSE "
            "'2020-01-0' || CAST(c_custkey % 9 + 1 AS STRING) END",
        },
    ),
    "tags": (
        "events",
        {
            "tag": _TAG,
            "timestamp": "ts",
            "value": "CASE WHEN event_id % 199 = 0 THEN NULL ELSE value END",
            "status": "CASE WHEN event_id % 199 = 0 THEN -1 WHEN event_id % 97 = 0 THEN -2 ELSE 0 END",
            "mine": "'M00' || CAST(user_id % 5 + 1 AS STRING)",
            "face": "'FACE_' || substr('ABC', CAST(user_id % 3 + 1 AS INT), 1)",
            "row_no": "event_id",
        },
    ),
    "samples": (
        "lineitem",
        {
            "SAMPLE_ID": "'LM' || CAST(l_orderkey AS STRING) || CAST(l_linenumber AS STRING)",
            "MINE_CODE": "'M00' || CAST(l_suppkey % 5 + 2 AS STRING)",
            "MINE_NAME": "'矿井' || CAST(l_suppkey % 5 + 2 AS STRING)",
            "SAMPLE_TYPE": _COAL,
            "SAMPLING_DATE": _DAY.format("l_shipdate"),
            "TEST_DATE": "CAST(CAST(CAST(l_shipdate AS DATE) + CAST(l_partkey % 40 - 3 AS INT) AS DATE) AS STRING)",
            "TEST_LAB": "'LAB' || CAST(l_suppkey % 4 AS STRING)",
            "AD": "CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN l_partkey % 67 = 0 THEN 0.0 - l_quantity "
            "WHEN l_partkey % 71 = 0 THEN 1200.0 ELSE l_quantity END",
            "VD": "CASE WHEN l_partkey % 73 = 0 THEN NULL ELSE l_extendedprice END",
            "全硫St": "l_tax * 100 + 0.0",
            "QGR_AD": "l_discount * 100 + 0.0",
            "ROW_NO": "l_partkey",
        },
    ),
    "doc_flow": (
        "orders",
        {
            "FLOW_ID": "o_orderkey",
            "DOC_NO": "'DOC' || CAST(o_orderkey % 9973 AS STRING)",
            "FLOW_TYPE": _FLOW,
            "INITIATOR": "CASE WHEN o_orderkey % 107 = 0 THEN NULL ELSE 'U' || CAST(o_custkey % 50 AS STRING) END",
            "APPLY_DATE": "CASE WHEN o_orderkey % 109 = 0 THEN NULL ELSE " + _DAY.format("o_orderdate") + " END",
            "STATUS": "CASE o_orderstatus WHEN 'F' THEN '已完成' WHEN 'O' THEN '审批中' ELSE '已驳回' END",
            "AMOUNT": "CASE WHEN o_orderkey % 5 < 3 THEN NULL WHEN o_orderkey % 50 = 3 THEN 0.0 ELSE o_totalprice END",
        },
    ),
    "points": (
        "events",
        {
            "event_id": "event_id",
            "ts": "ts",
            "point": "CASE event_type WHEN 'error' THEN 'CH4_001_LEVEL' WHEN 'click' THEN 'CO_001_LEVEL' "
            "WHEN 'view' THEN 'TEMP_001_LEVEL' WHEN 'signup' THEN 'PUMP_001_FLOW' ELSE 'MINER_001_SPEED' END",
            "device": "'D' || CAST(user_id AS STRING)",
            "state": "event_type",
            "value": "value",
        },
    ),
}

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Order in which copies of a key count as "first" or "newest".
ROW_ORDER = {
    "vbak": ["ROW_NO"],
    "vbap": ["EDATU", "LIFNR", "MATNR", "NETWR", "KWMENG"],
}


class Tables:
    """Given tables and their roles, read lazily; columns that a query does not use are never read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._schemas = spark, sf_dir, {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def given(self, name: str) -> DataFrame:
        # Inferred once for each run of a query, which may read a table several times.
        path = self.path(name)
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.given(name)
        if name in ROLES:
            table, columns = ROLES[name]
            return self.given(table).selectExpr(*[f"{expr} AS `{alias}`" for alias, expr in columns.items()])
        if name.startswith("dwd_"):
            return self.cleaned(name.removeprefix("dwd_"))
        raise AttributeError(name)

    def cleaned(self, role: str) -> DataFrame:
        return clean(getattr(self, role), role, ROW_ORDER.get(role))


def _role_sql(name: str) -> str:
    table, columns = ROLES[name]
    picked = ", ".join(f'{expr} AS "{alias}"' for alias, expr in columns.items())
    return f"SELECT {picked} FROM {table}"


def half(expr: str, digits: int = 2) -> str:
    scale = float(10**digits)
    return f"(floor(({expr}) * CAST({scale} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({scale} AS DOUBLE))"


def dsum(expr: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def davg(expr: str, scale: int = 6) -> str:
    return f"({dsum(expr, scale)} / NULLIF(count({expr}), 0))"


def zpad(expr: str, width: int) -> str:
    return f"(CASE WHEN length({expr}) >= {width} THEN {expr} ELSE lpad({expr}, {width}, '0') END)"


def _first(source: str, where: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {source} WHERE {where}) WHERE rn = 1"
    )


_CLEANED_SQL = {
    "dwd_vbak": "SELECT * REPLACE ("
    + half("NETWR")
    + " AS NETWR) FROM ("
    + _first("vbak", "NETWR IS NOT NULL AND ERNAM IS NOT NULL AND VBELN IS NOT NULL", "VBELN", "ROW_NO")
    + ")",
    "dwd_vbap": _first(
        "vbap",
        "MATNR IS NOT NULL AND VBELN IS NOT NULL AND NETWR > 0",
        "VBELN, POSNR",
        "EDATU NULLS FIRST, LIFNR NULLS FIRST, MATNR NULLS FIRST, NETWR NULLS FIRST, KWMENG NULLS FIRST",
    ),
    "dwd_kna1": f"SELECT * REPLACE ({zpad('KUNNR', 10)} AS KUNNR) FROM kna1 "
    "WHERE NAME1 IS NOT NULL AND STCD1 IS NOT NULL AND KUNNR IS NOT NULL",
    "dwd_tags": "SELECT * FROM tags WHERE tag IS NOT NULL AND value IS NOT NULL AND status IS DISTINCT FROM -1 "
    "AND value BETWEEN 0 AND 10000",
    "dwd_samples": "SELECT * FROM samples WHERE SAMPLE_ID IS NOT NULL AND AD >= 0",
    "dwd_doc_flow": "SELECT * FROM doc_flow WHERE FLOW_TYPE IS NOT NULL AND APPLY_DATE IS NOT NULL",
}


def sql(roles: str, body: str, **ctes: str) -> str:
    """SQL text with the named roles (cleaned ones bring their raw role along) and further CTEs."""
    parts: dict[str, str] = {}
    for name in roles.split():
        raw = name.removeprefix("dwd_")
        parts.setdefault(raw, _role_sql(raw))
        if name.startswith("dwd_"):
            parts.setdefault(name, _CLEANED_SQL[name])
    parts.update(ctes)
    if not parts:
        return body
    return "WITH " + ", ".join(f"{n} AS ({text})" for n, text in parts.items()) + " " + body
