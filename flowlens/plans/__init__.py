from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
