"""A folder of dumps as a file stream into a store.

The stream carries file names alone: Spark's file source remembers which files
it has handed out, and the dumps themselves are read by the ingest of their day.
What became of each day lies beside the store's tables::

    arrivals/batch=B-day=D/   the day's files and whether they entered

It is written after the day has entered. A batch that is run again, because the
run ended between the two or before the stream noted the batch, passes over the days that are noted and
redoes the one that is not, which can only be the newest.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.store import HistoryStore
from ..sources.dumps import read_dump
from ..sources.files import exists
from ..sources.schema import DAY, as_day

FILES = "path string, modificationTime timestamp, length long, content binary"
NOTED = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField(DAY, T.DateType()),
        T.StructField("files", T.ArrayType(T.StringType())),
        T.StructField("status", T.StringType()),
    ]
)
TAKEN, LATE = "taken", "late"
# How files and folders of dumps are named.
# A dump written by several tasks is a folder of its name.
_NAMED = re.compile(r"/dump-(\d{4}-\d{2}-\d{2})(?:/adresses)?\.csv(?:/part-[^/]*\.csv)?$")


def arrivals(store: HistoryStore) -> DataFrame:
    """``batch, day, files, status`` of every dump that has arrived: ``taken`` or ``late``."""
    folder = f"{store.root}/arrivals"
    if not exists(store.spark, folder):
        return store.spark.createDataFrame([], NOTED)
    return store.spark.read.schema(NOTED).option("recursiveFileLookup", True).parquet(folder)


def take_in(store: HistoryStore, files: Sequence[str], batch: int) -> None:
    """Ingest the dumps ``files`` of a batch, a day after the other; running it again changes nothing.

    Several files of a day are one dump. A dump of a day before the newest one is late: it
    does not enter and is noted as such. Files of other names are passed over.
    """
    days: dict = {}
    for path in sorted(files):
        if named := _NAMED.search(path):
            days.setdefault(as_day(named[1]), []).append(path)
    noted = {r[DAY] for r in arrivals(store).filter(F.col("batch") == batch).select(DAY).collect()}
    for day in sorted(set(days) - noted):
        newest = max(store.days(), default=None)
        late = newest is not None and day < newest
        if not late:
            store.ingest(day, read_dump(store.spark, days[day], store.schema, mark=True))
        row = [(batch, day, days[day], LATE if late else TAKEN)]
        note = store.spark.createDataFrame(row, NOTED).coalesce(1)
        note.write.mode("overwrite").parquet(f"{store.root}/arrivals/batch={batch}-day={day.isoformat()}")


def ingest_arrivals(
    store: HistoryStore, folder: str, checkpoint: str | None = None, files_per_batch: int | None = None
) -> None:
    """Ingest all dumps that have come into ``folder`` since the last run, then end.

    Dumps are files ``dump-DAY.csv``, or ``adresses.csv`` in a folder
    ``dump-DAY``; either may be a folder of part files, which come all at once. The stream keeps what it has seen in ``checkpoint``, by default
    beside the store; another store needs another one. Bring files in by a
    rename, so that none is seen half written. If a run fails, the next one starts
    with the batch that failed.
    """
    reader = store.spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def arrived(rows: DataFrame, batch: int) -> None:
        # A name per file: the bytes of a file are not read here.
        take_in(store, [r["path"] for r in rows.select("path").collect()], batch)

    stream = (
        reader.load(folder)
        .select("path")
        .writeStream.foreachBatch(arrived)
        .option("checkpointLocation", checkpoint or f"{store.root}/arrivals_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
