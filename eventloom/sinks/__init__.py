from eventloom.sinks.files import export_csv, write_fact
from eventloom.sinks.jdbc import write_jdbc

__all__ = ["export_csv", "write_fact", "write_jdbc"]
