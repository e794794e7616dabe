from ludomart.sources.readers import read_csv, read_json_arrays, read_xml
from ludomart.sources.sinks import (
    write_csv,
    write_json_arrays,
    write_table,
    write_xml,
)
from ludomart.sources.snapshots import read_table
from ludomart.sources.split import read_csv_split, read_json_objects, read_json_split

__all__ = [
    "read_csv",
    "read_csv_split",
    "read_json_arrays",
    "read_json_objects",
    "read_json_split",
    "read_table",
    "read_xml",
    "write_csv",
    "write_json_arrays",
    "write_table",
    "write_xml",
]
