from retailgrain.rules.tables import (
    BARCODE_SCHEMA,
    BucketBound,
    CityRule,
    MetricRule,
    ShopRule,
    barcode_table,
    rule_table,
)

__all__ = [
    "BARCODE_SCHEMA",
    "BucketBound",
    "CityRule",
    "MetricRule",
    "ShopRule",
    "barcode_table",
    "rule_table",
]
