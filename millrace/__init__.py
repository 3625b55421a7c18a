"""millrace: change feeds in, exact current-state tables out, on Spark DataFrames."""

from millrace.spec import SchemaChange, TableSpec

__all__ = ["SchemaChange", "TableSpec"]
