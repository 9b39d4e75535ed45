"""Make this package importable on the executors of a session that does not have it installed."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent
ARCHIVE = f"{PACKAGE.name}.zip"


def ship(spark: SparkSession) -> None:
    """Send the package's sources along with the application, once per application."""
    context = spark.sparkContext
    if any(name.endswith(f"/{ARCHIVE}") for name in context.listFiles):
        return
    archive = Path(tempfile.mkdtemp(prefix="volspark-")) / ARCHIVE
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(PACKAGE.rglob("*.py")):
            bundle.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
