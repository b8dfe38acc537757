"""All registered queries and the SQL that checks them."""

from fareloom.catalog import learning, modelling, modelling_sql, report_sql, reports
from fareloom.catalog.registry import QUERIES

SQL = {**report_sql.SQL, **modelling_sql.SQL}

__all__ = ["QUERIES", "SQL", "learning", "modelling", "reports"]
