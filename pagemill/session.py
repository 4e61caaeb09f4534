"""Session helpers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the executors' Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = Path(__file__).parent
    out = Path(tempfile.mkdtemp(prefix="pagemill-")) / f"{here.name}.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(out))
    _shipped.add(app)
