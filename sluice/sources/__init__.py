from .readers import read_table, read_folder, unreadable_files, read_checked, rejected_rows, with_source, header_inventory, schema_conformance
from .writers import write_table, write_parts_by_group

__all__ = ["read_table", "read_folder", "unreadable_files", "read_checked", "rejected_rows", "with_source", "header_inventory",
           "schema_conformance", "write_table", "write_parts_by_group"]
