from shelfcast.catalog.oracles import oracle_sql
from shelfcast.catalog.queries import queries

__all__ = ["oracle_sql", "queries"]
