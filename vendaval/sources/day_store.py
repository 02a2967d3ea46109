"""Rows of a stream in Parquet by day: one write per micro-batch, folded into few files.

Three areas: each micro-batch writes partitions of its own into ``open``; every so many of them
are folded into one set of files per day in ``folded``; and days that can get no more rows
become one set of files in ``closed``. A mark of one row, published after a fold, tells readers
which micro-batches are folded and which days are closed, so they see every row once at any
moment. All writes overwrite their own partitions only (Spark's dynamic partition overwrite),
so a micro-batch or a fold that is repeated adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaval.sources.files import delete_path, empty, list_names
from vendaval.sources.versioned import publish, read_current

DAY, MICRO, UPTO = "dia", "micro", "ate"

_MARK = T.StructType([T.StructField("folded", T.LongType()), T.StructField("closed", T.DateType())])


@dataclass(frozen=True)
class DayStore:
    """``schema`` is that of the stored rows with their ``dia``; ``by`` parts them further.

    With ``closes`` a day gets no rows once a later one has (windows come in the order of
    their ends); else rows of any day may come at any time, and days are never closed.
    """

    root: str
    schema: T.StructType
    by: str | None = None
    closes: bool = True
    fold_every: int = 64

    def mark(self, spark: SparkSession) -> tuple[int, date | None]:
        """(last folded micro-batch or -1, last closed day or none)."""
        row = read_current(spark, f"{self.root}/mark", _MARK).first()
        return (row["folded"], row["closed"]) if row else (-1, None)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows of a micro-batch; every ``fold_every`` of them, fold."""
        self._write(rows.withColumn(MICRO, F.lit(batch_id)), "open", [MICRO, *self._by, DAY])
        if (batch_id + 1) % self.fold_every == 0:
            self.fold(rows.sparkSession, batch_id)

    def read(self, spark: SparkSession, after: date | None = None, upto: date | None = None) -> DataFrame:
        """All rows, or those of the days after ``after`` and up to ``upto``.

        Closed days are not listed or read if ``after`` is the last of them. A reader that
        takes longer than the next fold, or meets a purge, fails and is run again.
        """
        folded, closed = self.mark(spark)
        parts = [self._area(spark, "open").where(F.col(MICRO) > folded)]
        if folded >= 0:
            rows = self._area(spark, "folded").where(F.col(UPTO) <= folded)
            parts.append(rows if closed is None else rows.where(F.col(DAY) > F.lit(closed)))
        if closed is not None and (after is None or after < closed):
            parts.append(self._area(spark, "closed").where(F.col(DAY) <= F.lit(closed)))
        names = self.schema.fieldNames()
        rows = parts[0].select(*names)
        for part in parts[1:]:
            rows = rows.unionByName(part.select(*names))
        if after is not None:
            rows = rows.where(F.col(DAY) > F.lit(after))
        return rows if upto is None else rows.where(F.col(DAY) <= F.lit(upto))

    def fold(self, spark: SparkSession, batch_id: int) -> None:
        """Fold the micro-batches up to ``batch_id``, and close the days before the newest."""
        folded, closed = self.mark(spark)
        if batch_id <= folded:
            return
        fresh = self._area(spark, "open").where((F.col(MICRO) > folded) & (F.col(MICRO) <= batch_id))
        closing = closed
        if self.closes:
            newest = fresh.agg(F.max(DAY)).first()[0]
            if newest is not None and (closed is None or newest - timedelta(days=1) > closed):
                closing = newest - timedelta(days=1)
        names = self.schema.fieldNames()
        fresh = fresh.select(*names)
        staying = fresh
        if closing != closed:
            staying = fresh.where(F.col(DAY) > F.lit(closing))
            earlier = self._area(spark, "folded").where(F.col(UPTO) <= folded).select(*names)
            leaving = earlier.unionByName(fresh).where(F.col(DAY) <= F.lit(closing))
            if closed is not None:
                leaving = leaving.where(F.col(DAY) > F.lit(closed))
            self._write(leaving, "closed", [DAY, *self._by])
        self._write(staying.withColumn(UPTO, F.lit(batch_id)), "folded", [DAY, UPTO, *self._by])
        publish(spark.createDataFrame([(batch_id, closing)], _MARK).coalesce(1), f"{self.root}/mark")
        # What the mark before this one had replaced already.
        self._delete(spark, "open", MICRO, lambda value: int(value) <= folded)
        if closed is not None:
            self._delete(spark, "folded", DAY, lambda value: date.fromisoformat(value) <= closed)

    def purge(self, spark: SparkSession, id_column: str, cutoff: int) -> list[str]:
        """Delete days none of whose rows is beyond ``cutoff``; returns them.

        Only folded rows are looked at: closed days, or, where days never close, those
        folded so far. Their ids are read, not the rest of the rows.
        """
        folded, closed = self.mark(spark)
        area = "closed" if self.closes else "folded"
        if folded < 0 or (self.closes and closed is None):
            return []
        rows = self._area(spark, area)
        rows = rows.where(F.col(DAY) <= F.lit(closed)) if self.closes else rows.where(F.col(UPTO) <= folded)
        days = rows.groupBy(DAY).agg(F.max(id_column).alias("newest")).where(F.col("newest") <= cutoff)
        gone = sorted(str(r[DAY]) for r in days.select(DAY).collect())  # a row per day
        for day in gone:
            path = f"{self.root}/{area}/{DAY}={day}"
            # Not what was folded after the mark was read.
            names = [""] if self.closes else list_names(spark, path)
            for name in names:
                if self.closes or int(name.split("=")[1]) <= folded:
                    delete_path(spark, f"{path}/{name}")
        return gone

    @property
    def _by(self) -> list[str]:
        return [self.by] if self.by else []

    def _area(self, spark: SparkSession, area: str) -> DataFrame:
        kinds = {MICRO: T.LongType(), UPTO: T.LongType()}
        own = {"open": [MICRO], "folded": [UPTO], "closed": []}[area]
        schema = T.StructType([*self.schema.fields, *[T.StructField(c, kinds[c]) for c in own]])
        path = f"{self.root}/{area}"
        if not list_names(spark, path):
            return empty(spark, schema)
        return spark.read.schema(schema).parquet(path)

    def _write(self, rows: DataFrame, area: str, parts: list[str]) -> None:
        writer = rows.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts)
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/{area}")

    def _delete(self, spark: SparkSession, area: str, part: str, doomed) -> None:
        for name in list_names(spark, f"{self.root}/{area}"):
            if name.startswith(f"{part}=") and doomed(name.split("=", 1)[1]):
                delete_path(spark, f"{self.root}/{area}/{name}")
