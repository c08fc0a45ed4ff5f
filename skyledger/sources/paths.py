"""Files that tasks open by path, and lists of them dealt over tasks."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame

from skyledger.session import materialise, send_code_with_tasks

send_code_with_tasks(__name__)

MAX_READ_TASKS = 100_000


def open_path(path: str):
    """Seekable binary file for a path as Spark prints it (``file:``, ``hdfs:``, ``s3a:`` ...)."""
    system, inner = file_system(path)
    return system.open_input_file(inner)


def file_system(path: str):
    """The file system of a path as Spark prints it, and the path within it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def spread_members(members: DataFrame, label: str = "archive-members") -> DataFrame:
    """Store the member list and give every member its own task where possible.

    The list must be counted first, because a plain repartition of such tiny rows
    would be merged back into one task.
    """
    stored = materialise(members, label)
    return stored.repartition(max(1, min(stored.count(), MAX_READ_TASKS)))
