"""Sessions, and shipping this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def session(name: str = "inspectra", cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session with UTC time; a cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per session, so that
    Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_inspectra_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="inspectra-src-")
    path = os.path.join(folder, "inspectra_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._inspectra_shipped = True
