from .tables import (
    TableRef,
    cluster,
    range_predicates,
    read_clustered,
    read_jdbc_partitioned,
    read_jdbc_split,
    read_table,
    scratch_path,
    shared_dir,
    split_points,
    write_clustered,
    write_table,
)

__all__ = [
    "TableRef",
    "cluster",
    "range_predicates",
    "read_clustered",
    "read_jdbc_partitioned",
    "read_jdbc_split",
    "read_table",
    "scratch_path",
    "shared_dir",
    "split_points",
    "write_clustered",
    "write_table",
]
