"""valuepay — customer-value and payment analytics expressed as Spark DataFrame plans.

Layout:
  sources/    typed CSV landing, source registry, driver-table adapters
  operators/  aggregate, join and exact-quantile building blocks
  functions/  scalar column helpers (rounding, dates, segment labels)
  plans/      marts, dashboard cards, scenario sweep, quality gates, refresh
"""

__version__ = "0.1.0"
