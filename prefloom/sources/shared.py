"""Small files in a folder that the driver and all tasks reach, without the JVM.

The folder is a path or an address that Arrow's file systems know (mounted paths,
``file:``, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``folder`` and the path in it."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def names(folder: str) -> list[str]:
    """Names of what lies in ``folder``, sorted; none while it does not exist. What begins
    with ``_`` or ``.`` is hidden, as from Spark."""
    system, path = opened(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name[0] not in "_.")


def exists(path: str) -> bool:
    system, inside = opened(path)
    return system.get_file_info(inside).type != fs.FileType.NotFound


def publish(table: pa.Table, folder: str, name: str) -> None:
    """Write a Parquet file that becomes visible as a whole or not at all."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    hidden = f"{path}/_{uuid.uuid4().hex}"
    pq.write_table(table, hidden, filesystem=system, compression="zstd")
    system.move(hidden, f"{path}/{name}")


def read_tables(folder: str, columns: Sequence[str]) -> list[pa.Table]:
    """The columns of all Parquet files of ``folder``."""
    system, path = opened(folder)
    return [pq.read_table(f"{path}/{n}", columns=list(columns), filesystem=system) for n in names(folder)]


def remove(folder: str) -> None:
    """Delete a folder that may be there."""
    system, path = opened(folder)
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_dir(path)


def bind(folder: str, create: bool = True, **properties) -> None:
    """Remember with which properties ``folder`` is used; other ones are refused. Without ``create``
    a folder that nobody has bound stays as it is."""
    system, path = opened(folder)
    place = f"{path}/_properties.json"
    mine = json.dumps(properties, sort_keys=True)
    if system.get_file_info(place).type == fs.FileType.NotFound:
        if create:
            system.create_dir(path, recursive=True)
            hidden = f"{place}.{uuid.uuid4().hex}"
            with system.open_output_stream(hidden) as f:
                f.write(mine.encode())
            system.move(hidden, place)
        return
    with system.open_input_stream(place) as f:
        theirs = f.read().decode()
    if theirs != mine:
        raise ValueError(f"{folder} is used with {theirs}, not with {mine}")
