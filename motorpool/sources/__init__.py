from .control import StartDate
from .files import land_extract, load_raw, read_csv, write_csv
from .jdbc import append_jdbc, day_slices, read_jdbc
from .state import PartitionedState
from .warehouse import Warehouse, create_layers, recreate_table

__all__ = [
    "PartitionedState", "StartDate", "Warehouse", "append_jdbc", "create_layers",
    "day_slices", "land_extract", "load_raw", "read_csv", "read_jdbc", "recreate_table",
    "write_csv",
]
