"""Commerce analytics as lazy Spark DataFrame jobs."""

from marketloom.params import Params
from marketloom.shop import Shop

__all__ = ["Params", "Shop"]
