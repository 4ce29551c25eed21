"""Small files in a shared folder, read and written by tasks through ``pyarrow.fs``.

Folders are named once, on the driver, with the scheme of the cluster's file system
(:func:`qualified`); a file that should be there and is not is an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder name with its scheme, as Spark itself would resolve it: a path without one lies
    on the cluster's default file system, not on each machine's disk."""
    if "://" in folder or folder.startswith("file:"):
        return folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def file_system(folder: str):
    """File system and path of a folder name with a scheme."""
    from pyarrow import fs

    if ":/" not in folder:
        raise ValueError(f"{folder} has no scheme: a task could not tell a shared folder from its own disk")
    return fs.FileSystem.from_uri(folder)


def write_file(files, path: str, data: bytes) -> None:
    """Write under a name of the attempt, then rename: readers see the whole file or none."""
    folder, _, name = path.rpartition("/")
    files.create_dir(folder, recursive=True)
    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as out:
        out.write(data)
    files.move(attempt, path)


def read_file(files, path: str) -> bytes:
    """A file's bytes."""
    with files.open_input_file(path) as f:
        return f.read()
