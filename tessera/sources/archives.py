"""Members of zip and tar archives as rows."""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tessera.session import ship

_SCHEMA = "path string, member string, size long, content binary, status string"


def read_members(blob: bytes, keep: str, content: bool) -> Iterator[tuple[str | None, int | None, bytes | None, str]]:
    """(member, size, content, status) of an archive's files whose names match; one row without a member if there is
    none ('no_useful_members') or the archive cannot be read ('error: ...'), after those read before the fault."""
    wanted, n = re.compile(keep), 0
    try:
        if blob[:2] == b"PK":
            with zipfile.ZipFile(io.BytesIO(blob)) as z:
                for m in z.infolist():
                    if not m.is_dir() and wanted.search(m.filename):
                        yield m.filename, m.file_size, z.read(m) if content else None, "ok"
                        n += 1
        else:
            with tarfile.open(fileobj=io.BytesIO(blob), mode="r:*") as t:
                for m in t:
                    if m.isfile() and wanted.search(m.name):
                        yield m.name, m.size, t.extractfile(m).read() if content else None, "ok"
                        n += 1
    except Exception as e:  # a corrupt or truncated archive is a row, not an end
        yield None, None, None, f"error: {type(e).__name__}"
        return
    if not n:
        yield None, None, None, "no_useful_members"


def archive_members(spark: SparkSession, paths: str | list[str], keep: str = ".", content: bool = True) -> DataFrame:
    """Rows (path, member, size, content, status) of the members of archives that match ``keep``.

    The kind of archive is told by its first bytes, not by its name (zip; tar, plain or compressed). Archives are read
    through Spark's file systems, one a task row, so one of more than 2 GB is refused by the reader; an
    empty file gives no row.
    """
    ship(spark)
    blobs = spark.read.format("binaryFile").load(paths).select("path", "content")

    def members(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            for path, blob in zip(batch["path"], batch["content"]):
                for row in read_members(bytes(blob), keep, content):
                    yield pd.DataFrame([(path, *row)], columns=["path", "member", "size", "content", "status"]).astype({"size": "Int64"})

    return blobs.mapInPandas(members, _SCHEMA)
