from ludomart.catalog.oracle import ORACLE
from ludomart.catalog.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
