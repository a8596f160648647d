"""Business constants that results must agree on. No logic lives here."""

# --- fixed values: acceptable ash range by coal type (percent) ---
ASH_RANGES = {
    "原煤": (10.0, 50.0),
    "精煤": (5.0, 15.0),
    "中煤": (15.0, 45.0),
    "矸石": (45.0, 90.0),
    "洗煤": (5.0, 20.0),
}

# --- fixed values: the tighter ash range used on daily increments (percent) ---
ASH_RANGES_DAILY = {
    "原煤": (15.0, 35.0),
    "精煤": (6.0, 12.0),
    "中煤": (20.0, 40.0),
    "矸石": (50.0, 80.0),
    "洗煤": (8.0, 18.0),
}

# --- fixed values: weights of the four quality dimensions ---
SCORE_WEIGHTS = {"completeness": 0.3, "consistency": 0.3, "accuracy": 0.2, "uniqueness": 0.2}

# --- fixed values: the two grade scales ---
GRADES_SCAN = [(95.0, "A"), (85.0, "B"), (70.0, "C")]
GRADES_CHECKPOINT = [(90.0, "A"), (80.0, "B"), (70.0, "C")]

# --- fixed values: alert threshold on a table score ---
ALERT_THRESHOLD = 70.0

# --- fixed values: unit cost per alert (key, label, unit, yuan) ---
ALERT_COSTS = [
    ("SAP.dup_vbak", "VBAK 销售订单重复", "元/条", 8.0),
    ("SAP.invalid_link_pct", "VBAP 关联失效（孤儿行项目）", "元/条", 12.0),
    ("PI.wagas_danger_pct", "瓦斯浓度超 1% 告警", "元/起", 50000.0),
    ("PI.wagas_anomaly_pct", "瓦斯异常突升（> 3x 基线）", "元/起", 20000.0),
    ("LIMS.ad_outlier_pct", "煤质灰分超合理区间", "元/条", 15.0),
    ("LIMS.dup_pct", "LIMS 重复检测批次", "元/条", 6.0),
    ("OA.dup_pct", "OA 重复流程记录", "元/条", 2.0),
]

# --- fixed values: sensor type -> (normal low, normal high, alarm, danger) ---
SENSOR_LIMITS = {
    "WAGAS": (0.0, 0.5, 0.8, 1.0),
    "CO": (0.0, 24.0, 24.0, 50.0),
    "TEMP": (15.0, 35.0, 38.0, 45.0),
}

# --- fixed values: equipment point -> alarm threshold (None: never alarms) ---
POINT_ALARMS = {
    "BELT_001_SPEED": 4.5,
    "BELT_001_STATUS": 3.0,
    "BELT_002_SPEED": 4.5,
    "BELT_002_STATUS": 3.0,
    "PUMP_001_STATUS": 2.0,
    "PUMP_001_FLOW": 180.0,
    "PUMP_001_PRESSURE": 1.8,
    "PUMP_002_STATUS": 2.0,
    "PUMP_002_FLOW": 180.0,
    "FAN_001_SPEED": 1450.0,
    "FAN_001_TEMP": 70.0,
    "FAN_001_STATUS": 2.0,
    "FAN_002_SPEED": 1450.0,
    "HOIST_001_POSITION": None,
    "HOIST_001_SPEED": 9.0,
    "HOIST_001_STATUS": 3.0,
    "HOIST_001_LOAD": 18.0,
    "SHIELD_001_PRESSURE": 45.0,
    "SHIELD_002_PRESSURE": 45.0,
    "MINER_001_STATUS": None,
    "MINER_001_SPEED": None,
    "CH4_001_LEVEL": 0.8,
    "CO_001_LEVEL": 24.0,
    "TEMP_001_LEVEL": 35.0,
}

# --- fixed values: cleaned table by source system -> by subject ---
SUBJECT_PATHS = {
    "sap_erp/dwd_vbak": "sales/dwd_vbak",
    "sap_erp/dwd_vbap": "sales/dwd_vbap",
    "sap_erp/dwd_kna1": "sales/dwd_kna1",
    "pi_system/dwd_tags": "production/dwd_tags",
    "lims/dwd_samples": "coal_quality/dwd_samples",
    "oa/dwd_doc_flow": "finance/dwd_doc_flow",
}

# --- fixed values: system -> (owner, security level, tables with their labels) ---
SYSTEM_ASSETS = {
    "lims": ("煤质中心", "重要资产", {"samples": "煤质化验样品"}),
    "sap_erp": (
        "销售部",
        "重要资产",
        {
            "kna1": "客户主数据",
            "vbak": "销售订单抬头",
            "vbap": "销售订单行项目",
            "likp": "交货单抬头",
            "lips": "交货单行项目",
            "mara": "物料主数据",
        },
    ),
    "pi_system": ("安全部", "核心资产", {"tags": "PI 时序标签数据"}),
    "oa": ("综合管理部", "一般资产", {"doc_flow": "文档流转记录", "contract": "合同记录", "meeting": "会议记录"}),
    "scada": ("安全部", "核心资产", {"equipment_status": "设备状态"}),
}

# --- fixed values: lineage layers, sources first ---
LAYER_ORDER = ["sap_erp", "pi_system", "lims", "oa", "scada", "dwd", "dwa"]

# --- fixed values: pattern -> label of a column transformation, in order of report ---
TRANSFORM_LABELS = [
    (r"\bAVG\s*\(", "AVG聚合"),
    (r"\bSUM\s*\(", "SUM累加"),
    (r"\bCOUNT\s*\(", "COUNT计数"),
    (r"\bMAX\s*\(", "MAX极值"),
    (r"\bMIN\s*\(", "MIN极值"),
    (r"\bSUBSTR\s*\(", "字符串派生"),
    (r"\bCAST\s*\(", "类型转换"),
    (r"\bSTRFTIME\s*\(", "日期格式化"),
    (r"\bDATE_TRUNC\s*\(", "日期截断"),
    (r"\bCONCAT\s*\(|^\s*\|\|", "字符串拼接"),
    (r"ROUND\s*\(", "四舍五入"),
    (r"COALESCE\s*\(", "空值兜底"),
]
DIRECT_TRANSFORMS = ["", "直接映射", "IDENTITY", "identity"]

# --- fixed values: quality rules per source table ---
NOT_NULL, UNIQUE, BETWEEN, LENGTH = (
    "expect_column_values_to_not_be_null",
    "expect_column_values_to_be_unique",
    "expect_column_values_to_be_between",
    "expect_column_value_lengths_to_be_between",
)
QUALITY_RULES = {
    ("sap_erp", "vbak"): [
        (NOT_NULL, ("VBELN",), None, None),
        (NOT_NULL, ("NETWR",), None, None),
        (NOT_NULL, ("ERNAM",), None, None),
        (NOT_NULL, ("KUNNR",), None, None),
        (UNIQUE, ("VBELN",), None, None),
        (BETWEEN, ("NETWR",), 0, None),
    ],
    ("sap_erp", "vbap"): [
        (NOT_NULL, ("VBELN",), None, None),
        (NOT_NULL, ("MATNR",), None, None),
        (UNIQUE, ("VBELN", "POSNR"), None, None),
        (BETWEEN, ("NETWR",), 0, None),
    ],
    ("sap_erp", "kna1"): [
        (NOT_NULL, ("KUNNR",), None, None),
        (NOT_NULL, ("NAME1",), None, None),
        (NOT_NULL, ("STCD1",), None, None),
        (UNIQUE, ("KUNNR",), None, None),
        (LENGTH, ("STCD1",), 17, 20),
    ],
    ("pi_system", "tags"): [
        (NOT_NULL, ("tag",), None, None),
        (NOT_NULL, ("value",), None, None),
        (NOT_NULL, ("timestamp",), None, None),
        (BETWEEN, ("status",), 0, None),
        (BETWEEN, ("value",), 0, 10000),
    ],
    ("lims", "samples"): [
        (NOT_NULL, ("SAMPLE_ID",), None, None),
        (NOT_NULL, ("AD",), None, None),
        (NOT_NULL, ("VD",), None, None),
        (NOT_NULL, ("全硫St",), None, None),
        (UNIQUE, ("SAMPLE_ID",), None, None),
        (BETWEEN, ("AD",), 0, 100),
        (BETWEEN, ("全硫St",), 0, 10),
    ],
    ("oa", "doc_flow"): [
        (NOT_NULL, ("FLOW_ID",), None, None),
        (NOT_NULL, ("FLOW_TYPE",), None, None),
        (NOT_NULL, ("INITIATOR",), None, None),
        (BETWEEN, ("AMOUNT",), 0, None),
    ],
}
