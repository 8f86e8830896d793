"""Price surveillance and data-shaping operators for large fare tables, on PySpark."""

from fareflow.params import FareParams
from fareflow.plans.build import FareTables

__all__ = ["FareParams", "FareTables"]
