"""What several operators share: tables, words, and files in the folder all executors reach."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

# A word is a run of anything but space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD_RUN).findall


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_splits(df: DataFrame) -> int:
    """Tasks to deal a whole table to: the shuffle width, or the scan's if that is wider."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, df.rdd.getNumPartitions())


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address and the path in it; a bare path is a local one."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def publish(fs: pafs.FileSystem, folder: str, name: str, attempt: int, body: Iterator[bytes]) -> int:
    """Writes a file under an attempt's name and then gives it its own: bytes written.

    A task that runs again, or twice at once, writes the same bytes, so whichever
    attempt is last does no harm, and readers never see half a file.  Where a file
    system does not move onto a name that is taken, the file that is there stays.
    """
    fs.create_dir(folder, recursive=True)
    draft = f"{folder}/_{name}.{attempt}"
    size = 0
    with fs.open_output_stream(draft, compression=None) as out:
        for block in body:
            out.write(block)
            size += len(block)
    target = f"{folder}/{name}"
    try:
        fs.move(draft, target)
    except OSError:
        if fs.get_file_info(target).type != pafs.FileType.File:
            raise
        fs.delete_file(draft)
    return size
