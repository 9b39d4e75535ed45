"""Market folders: many underliers written in one job, as ``read_market`` reads them.

Lines are brought into the order of the files by one range shuffle, so a file may span tasks and
no underlier has to fit into one. A task writes what it holds of a file under a name of its own in
a hidden staging folder; the commit moves the files of the tasks that count into place. A file
that one task holds becomes ``<name>``; one that spans tasks becomes a folder of that name with a
part for each task, which reads the same. Lost tasks are repeated, a failed job leaves nothing
but, at most, its staging folder.

Listing and opening files costs more than reading a few lines from each. So from ``OWN_FILES``
underliers on, all of them share one file of each kind, in parts, with the underlier as last column:
the files then grow in number with the tasks and not with the underliers.
"""

import functools
import uuid
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..shipping import ship
from .chain import CHAIN_COLUMNS
from .market import CALL_FILE, DIVIDEND_FILE, PUT_FILE, RATE_FILE, SHARED, SPOT_FILE

FORMAT = "market_folder"
SCHEMA = "file string, header string, line string"
MOVERS = 16  # files moved at a time by the commit
OWN_FILES = 250  # most underliers that have files of their own


def filesystem(folder: str):
    """The file system of a path or URI (local, HDFS, S3, GCS), and the path there."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its number, and the staged path of each file."""

    task: int
    files: dict[str, str]


class FolderWriter(DataSourceArrowWriter):
    """Writes (file, header, line) rows, the lines of a file one behind the other."""

    def __init__(self, folder: str, job: str):
        self.folder, self.stage = folder, f".staged-{job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        store, root = filesystem(self.folder)
        stage = f"{root}/{self.stage}/{context.partitionId()}-{context.taskAttemptId()}"
        files, name, out = {}, None, None
        try:
            for batch in iterator:
                rows = zip(*batch.select(["file", "header", "line"]).to_pydict().values())
                for (file, header), lines in groupby(rows, itemgetter(0, 1)):
                    if file != name:
                        if out:
                            out.close()
                        if not files:
                            store.create_dir(stage, recursive=True)
                        name, files[file] = file, f"{stage}/{file}"
                        out = store.open_output_stream(files[file])
                        out.write(f"{header}\n".encode())
                    out.write("".join(f"{line}\n" for _, _, line in lines).encode())
        finally:
            if out:
                out.close()
        return Written(context.partitionId(), files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.folder)
        parts = defaultdict(list)
        for message in filter(None, messages):
            for file, staged in message.files.items():
                parts[file].append((message.task, staged))
        moves = []
        for file, staged in parts.items():
            if len(staged) == 1:
                moves.append((staged[0][1], f"{root}/{file}"))
            else:
                store.create_dir(f"{root}/{file}", recursive=True)
                moves += [(path, f"{root}/{file}/part-{task:05d}.csv") for task, path in staged]
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda move: store.move(*move), moves))
        self._drop_stage()

    def abort(self, messages: list[Written | None]) -> None:
        self._drop_stage()

    def _drop_stage(self) -> None:
        from pyarrow.fs import FileType

        store, root = filesystem(self.folder)
        if store.get_file_info(f"{root}/{self.stage}").type != FileType.NotFound:
            store.delete_dir(f"{root}/{self.stage}")


class MarketFolder(DataSource):
    """The write-only format behind ``write_market``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> FolderWriter:
        return FolderWriter(self.options["folder"], self.options["job"])


# Columns of the files by the end of their names.
COLUMNS = {
    CALL_FILE: CHAIN_COLUMNS, PUT_FILE: CHAIN_COLUMNS, SPOT_FILE: ("date", "spot"),
    DIVIDEND_FILE: ("Date", "amount"), RATE_FILE: ("tenor", "rate"),
}


def _lines(rows: DataFrame, file: Column, names: tuple[str, ...], day: str, number: str, of: Column | None = None) -> DataFrame:
    """file and line of each row, with the columns that order the lines of a file. ``of``, the
    underlier of a line of a shared file, becomes its last column."""
    present = [F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string") for c in names]
    cells = [value.alias(c) for value, c in zip(present, names)]
    kept = {}
    if of is not None:  # the name as it is, with its blanks
        cells.append(of.alias("underlier"))
        kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return rows.select(
        file.alias("file"), F.to_csv(F.struct(*cells), kept).alias("line"),
        (F.lit(None).cast("string") if of is None else of).alias("_of"),
        F.expr(day).cast("string").alias("_day"), F.expr(number).try_cast("double").alias("_number"),
    )


def _many(tables: list[DataFrame], limit: int) -> bool:
    """Whether the tables have more than ``limit`` underliers."""
    names = [t.select(F.col("underlier").cast("string")).distinct() for t in tables]
    every = functools.reduce(DataFrame.unionByName, names).distinct()
    return every.limit(limit + 1).count() > limit


def write_market(
    folder: str, quotes: DataFrame, spots: DataFrame, rates: DataFrame, dividends: DataFrame,
    own_files: int = OWN_FILES,
) -> None:
    """Write the files of a market folder that is not there yet.

    ``quotes`` has underlier, is_call and columns of a chain file (absent ones stay blank),
    ``spots`` underlier, date and spot, ``rates`` tenor and rate, ``dividends`` underlier, Date
    and amount. The lines of a file are in order of expiration and strike, of date, or of tenor.
    Up to ``own_files`` underliers have files of their own. More than that share files, named
    ``SHARED`` in place of the underlier, which lies in their last column; their lines are in order
    of underliers first.
    Rows without an underlier, or with one that holds a slash or a line break or is ``SHARED``, fail
    the job.
    """
    session = quotes.sparkSession
    ship(session)
    store, root = filesystem(folder)
    if store.get_file_info(root).is_file or len(store.get_file_info(_below(root))):
        raise FileExistsError(folder)
    text = F.col("underlier").cast("string")
    unfit = text.rlike("[/\\r\\n]") | (text == SHARED)
    named = F.when(unfit, F.raise_error(F.lit("an underlier holds a slash or a line break, or is reserved"))).otherwise(
        F.coalesce(text, F.raise_error(F.lit("a row has no underlier")))
    )
    shared = _many([quotes, spots, dividends], own_files)
    stem, of = (F.lit(SHARED), named) if shared else (named, None)
    side = F.when(F.col("is_call"), CALL_FILE).otherwise(PUT_FILE)
    lines = (
        _lines(quotes, F.concat(stem, side), CHAIN_COLUMNS, "expiration", "strike", of)
        .unionByName(_lines(spots, F.concat(stem, F.lit(SPOT_FILE)), COLUMNS[SPOT_FILE], "date", "0", of))
        .unionByName(_lines(dividends, F.concat(stem, F.lit(DIVIDEND_FILE)), COLUMNS[DIVIDEND_FILE], "Date", "0", of))
        .unionByName(_lines(rates, F.lit(RATE_FILE), COLUMNS[RATE_FILE], "null", "tenor"))
    )
    header = F.lit(None).cast("string")
    for ending, names in COLUMNS.items():
        whole = (*names, "underlier") if shared and ending != RATE_FILE else names
        header = F.when(F.col("file").endswith(ending), ",".join(whole)).otherwise(header)
    session.dataSource.register(MarketFolder)
    ordered = lines.orderBy("file", "_of", "_day", "_number", "line").select("file", header.alias("header"), "line")
    ordered.write.format(FORMAT).mode("append").options(folder=folder, job=uuid.uuid4().hex).save()


def _below(root: str):
    from pyarrow import fs

    return fs.FileSelector(root, allow_not_found=True)
