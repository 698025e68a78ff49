"""Files of own formats in the folder that driver and executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from kiln.session import checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new place for files, under the folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(uri: str):
    """``(file system, path)`` of a place: local paths and the schemes Arrow knows."""
    from pyarrow import fs
    local = re.match(r"file:/*(/.*)", uri)
    return fs.FileSystem.from_uri(local[1] if local else uri)
