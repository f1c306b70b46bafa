"""martlens: retail reporting and data-quality operators on Spark DataFrames.

Every operator is a pure function ``(tables, params) -> DataFrame``; nothing is
collected to the driver inside an operator.
"""

from martlens.params import Params
from martlens.plans.tables import RetailTables

__all__ = ["Params", "RetailTables"]
