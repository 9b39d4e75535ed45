"""Where rows stand in the files that they come from."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_position() -> Column:
    """Struct (file, block, line) that sorts as the rows of the files do.

    ``block`` is where the split that holds the row begins in its file, and ``line`` grows from row
    to row of a split, as a task reads a split from front to back. So the order of a file of any
    size is known without a shuffle, a sort or a second scan; only the differences of ``line`` mean
    nothing. It belongs in the first select after a file scan, ahead of filters and exchanges.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
