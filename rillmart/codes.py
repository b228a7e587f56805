"""Business codes of the commerce data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.timefns import col

# Codes as they stand in the source systems, by kind.
CODES: dict[str, dict[str, str]] = {
    "order_status": {
        "1001": "UNPAID",
        "1002": "PAID",
        "1003": "CANCEL",
        "1004": "FINISH",
        "1005": "REFUND",
        "1006": "REFUND_DONE",
    },
    "payment_type": {
        "1101": "ALIPAY",
        "1102": "WECHAT",
        "1103": "UNION",
    },
    "appraise": {
        "1201": "GOOD",
        "1202": "SOSO",
        "1203": "BAD",
        "1204": "AUTO",
    },
    "refund_reason": {
        "1301": "BAD_GOODS",
        "1302": "WRONG_DESC",
        "1303": "SALE_OUT",
        "1304": "SIZE_ISSUE",
        "1305": "MISTAKE",
        "1306": "NO_REASON",
        "1307": "OTHER",
    },
    "coupon_status": {
        "1401": "UNUSED",
        "1402": "USING",
        "1403": "USED",
    },
    "refund_type": {
        "1501": "ONLY_MONEY",
        "1502": "WITH_GOODS",
    },
    "source_type": {
        "2401": "QUERY",
        "2402": "PROMOTION",
        "2403": "AUTO_RECOMMEND",
        "2404": "ACTIVITY",
    },
    "activity_rule_type": {
        "3101": "MJ",
        "3102": "DZ",
        "3103": "ZK",
    },
    "coupon_type": {
        "3201": "MJ",
        "3202": "DZ",
        "3203": "DJ",
    },
    "coupon_range_type": {
        "3301": "CATEGORY3",
        "3302": "TRADEMARK",
        "3303": "SPU",
    },
}

APPRAISE_GOOD = "1201"

# What one search word is worth by where it came from.
KEYWORD_WEIGHTS: dict[str, int] = {
    "SEARCH": 10,
    "ORDER": 3,
    "CART": 2,
    "CLICK": 1,
}


def decode(kind: str, code: Column | str) -> Column:
    """Name of a code, NULL for an unknown one; a literal map, so no join."""
    pairs = [F.lit(part) for item in CODES[kind].items() for part in item]
    return F.create_map(*pairs)[col(code)]


def code_table(spark: SparkSession) -> DataFrame:
    """All codes as a table (kind, code, name)."""
    rows = [(kind, code, name) for kind, names in CODES.items() for code, name in names.items()]
    return spark.createDataFrame(rows, "kind string, code string, name string")


def keyword_weight(source: Column | str, weights: dict[str, int] | None = None) -> Column:
    """Weight of a keyword source, compared without regard to case; 0 if unlisted."""
    chain: Column | None = None
    for name, weight in (KEYWORD_WEIGHTS if weights is None else weights).items():
        test = F.upper(col(source)) == name.upper()
        chain = F.when(test, weight) if chain is None else chain.when(test, weight)
    return chain.otherwise(0) if chain is not None else F.lit(0)
