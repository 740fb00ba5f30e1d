"""ordertally: order, packing, customer and zone reports as Spark DataFrame plans."""

from ordertally.params import ReportParams, last_n_days, yesterday

__all__ = ["ReportParams", "last_n_days", "yesterday"]
