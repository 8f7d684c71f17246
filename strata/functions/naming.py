"""What a snapshot's path says about it: base name, fetch text and fetch time."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Year to second in a snapshot's name, and the same as a format.
TIME = r"(\d{4})-(\d{2})-(\d{2})__(\d{2})_(\d{2})_(\d{2})"
TIME_FORMAT = "yyyy-MM-dd__HH_mm_ss"


@dataclass(frozen=True)
class SnapshotName:
    """Naming rule ``<prefix><time><suffix>``, with the time in UTC."""

    prefix: str
    suffix: str

    def fetched_text(self, name: Column) -> Column:
        """The time part of a name, empty when the name does not follow the rule."""
        return F.regexp_extract(name, f"^{re.escape(self.prefix)}({TIME}){re.escape(self.suffix)}$", 1)

    def fetched_at(self, name: Column) -> Column:
        """Instant of the fetch, NULL when the name does not carry one."""
        parts = [F.regexp_extract(self.fetched_text(name), TIME, i).try_cast("int") for i in range(1, 7)]
        return F.try_make_timestamp(*parts, F.lit("UTC"))

    def name_for(self, fetched_at: Column) -> Column:
        """Name of a snapshot fetched at the given UTC wall-clock time."""
        return F.concat(F.lit(self.prefix), F.date_format(fetched_at, TIME_FORMAT), F.lit(self.suffix))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """Name of the folder a file lies in, without a ``key=`` in front."""
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.substring_index(folder, "=", -1)
