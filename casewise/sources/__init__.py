from casewise.sources.tables import TABLES, read_table, read_cases
from casewise.sources.views import cases_view, cases_nulls, CASE_COLUMNS

__all__ = ["TABLES", "read_table", "read_cases", "cases_view", "cases_nulls", "CASE_COLUMNS"]
