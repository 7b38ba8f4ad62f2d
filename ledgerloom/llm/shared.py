"""What tasks need from outside: this package's code, and files in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import SparkSession

import ledgerloom

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(ledgerloom.__file__).parent
    # the driver serves the file from here for as long as the application lasts
    path = f"{tempfile.mkdtemp(prefix='ledgerloom-code-')}/ledgerloom.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def new_name(stem: str, suffix: str) -> str:
    """A name no other attempt of any task uses; readers learn names from results of attempts that ended well."""
    return f"{stem}-{uuid.uuid4().hex}{suffix}"


def make_folder(uri: str) -> None:
    system, path = place(uri)
    system.create_dir(path, recursive=True)
