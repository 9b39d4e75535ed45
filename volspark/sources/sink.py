"""Table sink."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("parquet", "csv")
FILES_PER_DIRECTORY = 8


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (),
    mode: str = "errorifexists", files_per_directory: int = FILES_PER_DIRECTORY,
    max_records_per_file: int = 0,
) -> None:
    """Write a table; ``partition_by`` makes later reads prune directories.

    Rows are first spread by the partition columns plus a slice of the row hash, so a directory
    is written by ``files_per_directory`` tasks (no file per task and value) and a hot value by
    several. A file gets at most ``max_records_per_file`` rows (0: no limit).
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    if partition_by:
        slices = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_directory))
        df = df.repartition(*partition_by, slices)
    writer = df.write.mode(mode).format(fmt).option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
