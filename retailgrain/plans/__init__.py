from retailgrain.plans.order_cube import order_cube, to_cube_table
from retailgrain.plans.order_lines import order_lines
from retailgrain.plans.stock_recon import MatchLabels, recon_summary, reconcile
from retailgrain.plans.weekly_orders import week_beside_weekend, weekly_metrics, weekly_report, weekly_shop_metrics, weekly_table
from retailgrain.plans.yoy_sales import SalesScopes, fact_sums, max_date, yoy_bundle, yoy_report, yoy_sections

__all__ = [
    "MatchLabels",
    "SalesScopes",
    "fact_sums",
    "max_date",
    "order_cube",
    "order_lines",
    "recon_summary",
    "reconcile",
    "to_cube_table",
    "week_beside_weekend",
    "weekly_metrics",
    "weekly_report",
    "weekly_shop_metrics",
    "weekly_table",
    "yoy_bundle",
    "yoy_report",
    "yoy_sections",
]
