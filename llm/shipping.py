"""The package's code for the executors' Python processes."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from llm.scratch import shared_folder

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to all executors, once per application.

    Python functions name it by import, and executors need not have it installed.  The
    archive is made in memory and lies in the shared folder until the session ends.
    """
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    package = Path(__file__).resolve().parent
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{package.name}-{app}.zip")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(path, True)
    stream.write(bytearray(archive.getvalue()))
    stream.close()
    system.deleteOnExit(path)
    spark.sparkContext.addPyFile(path.toString())
    _sent.add(app)
