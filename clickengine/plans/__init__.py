from clickengine.plans.catalog import FLAGSHIP, oracle_sql, queries

__all__ = ["FLAGSHIP", "oracle_sql", "queries"]
