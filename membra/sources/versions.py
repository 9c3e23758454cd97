"""Version tables -> named snapshot files.

The reference extracts one file per commit with git; here a *version table*
(one row per version: date, sha, document lines) is the input, and Spark
writes one landing folder per version name.  New versions can be appended to
the same landing folder and picked up incrementally by
:mod:`membra.streaming.snapshot_stream`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.periods import version_file_name


def with_version_name(versions: DataFrame, prefix: str, commit_date: str, sha: str,
                      out: str = "file_name", ext: str = "yaml") -> DataFrame:
    """``<prefix>-<commit_date>-<sha[0:7]>.<ext>`` per version row."""
    return versions.withColumn(out, version_file_name(prefix, commit_date, sha, ext))


def land_versions(lines: DataFrame, path: str, name: str = "file_name", text: str = "line",
                  order: Sequence[str] = (), salt: str | None = None, mode: str = "append") -> None:
    """Write document lines as ``path/<name>=<version>/[<salt>=<k>/]part-*.txt``.

    Lines of one version (and salt) go to one task and keep ``order`` inside
    the file; the writer streams rows, so no document is held in memory whole.
    A ``salt`` column splits a large version into several complete documents
    (the caller builds each slice as a valid document), so one version never
    has to be written - or later decoded - by a single task.
    """
    keys = [name] + ([salt] if salt else [])
    (lines.repartition(*keys).sortWithinPartitions(*keys, *order)
     .select(*keys, text).write.mode(mode).partitionBy(*keys).text(path))
