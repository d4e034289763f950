"""The package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import SparkSession

from sessionloom.tables import shared_dir

_MARK = "_sessionloom_shipped"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they start: its sources go through Spark's file server, once a context."""
    context = spark.sparkContext
    if getattr(context, _MARK, False):
        return
    package = Path(__file__).resolve().parent
    shared = urlparse(shared_dir(spark))
    folder = Path(shared.path) if shared.scheme in ("", "file") else Path(tempfile.mkdtemp(prefix="sessionloom-"))
    folder.mkdir(parents=True, exist_ok=True)
    archive = folder / f"{package.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    setattr(context, _MARK, True)
