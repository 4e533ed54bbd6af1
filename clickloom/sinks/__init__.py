"""Writers."""

from clickloom.sinks.tables import (
    TaskRun,
    append,
    append_jdbc,
    read_results,
    replace_partitions,
    touched_partitions,
    upsert,
    write_result,
)

__all__ = [
    "TaskRun",
    "append",
    "append_jdbc",
    "read_results",
    "replace_partitions",
    "touched_partitions",
    "upsert",
    "write_result",
]
