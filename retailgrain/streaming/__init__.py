from retailgrain.streaming.intake import intake_stock_files, quarantined_files, taken_files
from retailgrain.streaming.orders import OrderMetrics
from retailgrain.streaming.parts import PartStore
from retailgrain.streaming.weekly import fold_batches, stored_counts, weekly_counts, weekly_counts_stream

__all__ = [
    "OrderMetrics",
    "PartStore",
    "fold_batches",
    "intake_stock_files",
    "quarantined_files",
    "stored_counts",
    "taken_files",
    "weekly_counts",
    "weekly_counts_stream",
]
