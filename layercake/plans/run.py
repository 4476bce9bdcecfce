"""What a run fixes: the day it counts from and its audit time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Run:
    """``as_of`` None means the current day; ``loaded_at`` None the current time.

    Results depend on the data and on these two values only. ``unique_orders`` says that order ids are known not to
    repeat (see ``keys_repeat``), so that marts need not look for repeats.
    """

    as_of: date | None = None
    loaded_at: datetime | None = None
    on_bad: str = "error"
    time_match: str = "exact"
    unique_orders: bool = False

    @property
    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)

    @property
    def now(self) -> Column:
        """The moment recency in hours counts from: midnight of ``as_of``, as a zone-free time."""
        if self.as_of is None:
            return F.localtimestamp()
        return F.lit(datetime(self.as_of.year, self.as_of.month, self.as_of.day)).cast("timestamp_ntz")

    @property
    def stamp(self) -> Column:
        return F.current_timestamp() if self.loaded_at is None else F.lit(self.loaded_at)

    def days_ago(self, days: int) -> Column:
        return F.date_sub(self.today, days)

    def audited(self, df: DataFrame) -> DataFrame:
        """With ``created_ts`` and ``updated_ts``, one value per run; ``created_ts`` survives."""
        created = F.col("created_ts") if "created_ts" in df.columns else self.stamp
        return df.withColumns({"created_ts": created, "updated_ts": self.stamp})
