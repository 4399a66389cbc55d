"""Plain append to a relational table; the driver jar comes with the cluster."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)

    def append(self, rows: DataFrame) -> None:
        """Executors write their own partitions; nothing passes the driver."""
        rows.write.jdbc(url=self.url, table=self.table, mode="append", properties=self.properties)

    def batch_writer(self) -> Callable[[DataFrame, int], None]:
        """The append as a ``foreachBatch`` callback."""
        return lambda batch, _batch_id: self.append(batch)
