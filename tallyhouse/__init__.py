"""Retail warehouse and analytics as Spark DataFrame jobs.

Every operator is a function ``(DataFrame..., parameters) -> DataFrame``; only
the jobs in ``plans.full_load``, ``plans.incremental`` and ``sources`` write.
"""

__version__ = "0.1.0"
