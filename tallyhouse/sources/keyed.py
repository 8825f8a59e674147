"""A table with one row per key: plain Parquet in month folders, clustered by key.

The table is an ordinary bucketed table of the session's catalog over its own folder. Its rows lie in buckets by key, so new rows meet the
ones they replace without the table being shuffled, and an upsert overwrites the month folders in which something changes.
One writer at a time; a reader during an upsert may see some months before and others after it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StructField, StructType

from tallyhouse.schemas import column_ddl
from tallyhouse.session import child_names, delete_path, forget_shuffles, make_folder, move_path, path_exists

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
EPOCH = dt.datetime(1970, 1, 1)

# Rows of a part by key, which one task of an upsert merges and sorts: some 200 MB in a stage of sales.
ROWS_PER_BUCKET = 1_000_000

#: Called with the run's name and the versions that came (sign 1) and went (sign -1); a run that is done again has the same name.
OnChange = Callable[[str, DataFrame], None]


def buckets_for(rows: int, least: int = 4) -> int:
    """The number of parts by key for a table of at most so many rows, so that what a task holds does not grow with the table."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


@dataclass(frozen=True)
class KeyedTable:
    """`mark_column` tells versions of a key apart, the larger one is newer; without it, rows that are sent replace what is there.

    `month_of` names the date or timestamp by whose month rows lie in folders, `buckets` in how many parts by key (0: not clustered),
    `watched` the columns that `on_change` gets to see. NULL keys match nothing unless `null_safe_keys` is set.
    """

    spark: SparkSession
    path: str
    schema: StructType
    keys: list[str]
    mark_column: str | None = None
    month_of: str | None = None
    buckets: int = 0
    null_safe_keys: bool = False
    watched: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return "default.tallyhouse_" + hashlib.md5(self.path.encode()).hexdigest()[:20]

    @property
    def month_column(self) -> str:
        return f"{self.month_of}_month"

    @property
    def _full(self) -> StructType:
        month = [StructField(self.month_column, DateType())] if self.month_of else []
        return StructType(self.schema.fields + month)

    def exists(self) -> bool:
        """Whether there is a table; one that another session wrote is entered in this session's catalog."""
        if not self.spark.catalog.tableExists(self.name):
            if not path_exists(self.spark, self.path):
                return False
            self._create()
        return True

    def _enter(self, name: str, path: str, in_months: bool = True) -> None:
        """Enter a folder in the catalog as a table with the columns and buckets of this one."""
        folders = f"PARTITIONED BY ({self.month_column})" if self.month_of and in_months else ""
        keys = ", ".join(self.keys)
        parts = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS" if self.buckets else ""
        make_folder(self.spark, path)
        where = path.replace("'", "\\'")
        columns = column_ddl(self._full)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') {folders} {parts} LOCATION '{where}'")

    def _create(self) -> None:
        self._enter(self.name, self.path)
        self._sync()

    def _sync(self) -> None:
        """Make the catalog's month folders those that are there."""
        if self.month_of:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.name)

    def _rows(self) -> DataFrame:
        """The rows as the folder has them now, whichever session wrote them last."""
        if not self.exists():
            return self.spark.createDataFrame([], self._full)
        if self.month_of:
            known = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
            if known != set(child_names(self.spark, self.path, f"{self.month_column}=*")):
                self._sync()
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def read(self, since: dt.date | None = None) -> DataFrame:
        """Current rows, one per key; with `since` those whose `month_of` is on or after that day, from the months' folders only."""
        rows = self._rows()
        if since is not None:
            rows = rows.where((F.col(self.month_column) >= F.lit(since.replace(day=1))) & (F.col(self.month_of) >= F.lit(since)))
        return rows.select(*self.schema.fieldNames())

    def high_water(self) -> dt.datetime | None:
        """Largest mark of any finished run; None if there is none. Noted after the rows, so an unfinished run does not count."""
        marks = [int(name.split("=")[1]) for name in child_names(self.spark, f"{self.path}.marks", "at=*")]
        return EPOCH + dt.timedelta(microseconds=max(marks)) if marks else None

    def _note_mark(self, mark: dt.datetime | None) -> None:
        """Marks are empty folders by name: each comes into being at once, and the older ones are then taken away."""
        old = child_names(self.spark, f"{self.path}.marks", "at=*")
        held = self.high_water()
        if mark is None or (held is not None and held >= mark):
            return
        new = f"at={(mark - EPOCH) // dt.timedelta(microseconds=1)}"
        make_folder(self.spark, f"{self.path}.marks/{new}")
        for name in old:
            delete_path(self.spark, f"{self.path}.marks/{name}")

    def _in_months(self, rows: DataFrame) -> DataFrame:
        named = rows.select(*self.schema.fieldNames())
        return named.withColumn(self.month_column, F.trunc(self.month_of, "MM")) if self.month_of else named

    def _insert(self, rows: DataFrame) -> None:
        """Overwrite the months of the rows. Each task writes one bucket, so a month has one file per bucket."""
        if self.buckets:
            rows = rows.repartition(self.buckets, *self.keys)
        elif self.month_of:
            rows = rows.hint("rebalance", self.month_column)
        conf = rows.sparkSession.conf
        before = conf.get(OVERWRITE_MODE)
        conf.set(OVERWRITE_MODE, "dynamic")
        try:
            rows.select(*self._full.fieldNames()).write.mode("overwrite").insertInto(self.name)
        finally:
            conf.set(OVERWRITE_MODE, before)

    def _months_and_mark(self, rows: DataFrame) -> tuple[set[dt.date | None], dt.datetime | None]:
        """Months that have rows, a value per month, and the largest mark."""
        month = F.col(self.month_column) if self.month_of else F.lit(None).cast("date")
        mark = F.max(self.mark_column) if self.mark_column else F.lit(None)
        months, undated, mark = rows.agg(F.collect_set(month), F.count_if(month.isNull()), mark).first()
        return set(months) | ({None} if undated else set()), mark

    def replace(self, rows: DataFrame) -> None:
        """The rows are the whole new content. They must not be read from this table, which is emptied first."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        for folder in (f"{self.path}.marks", f"{self.path}.pending", self.path):
            delete_path(self.spark, folder)
        self._create()
        self._insert(self._in_months(rows))
        self._note_mark(self._months_and_mark(self._rows())[1])

    def _same(self, other: str, null_safe: bool) -> Column:
        pairs = [(F.col(key), F.col(f"{other}{key}")) for key in self.keys]
        return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])

    def _by_key(self, held: DataFrame, new: DataFrame, how: str) -> DataFrame:
        """Held rows joined with new ones.

        Spark does not use buckets for a condition in which NULL equals NULL: it would shuffle the table. So rows without a NULL in
        their key meet by plain equality, and only those with one are dealt anew.
        """
        if not (self.null_safe_keys and self.buckets):
            return held.join(new, self._same("new_", self.null_safe_keys), how)
        lack = [reduce(lambda a, b: a | b, [F.col(f"{prefix}{key}").isNull() for key in self.keys]) for prefix in ("", "new_")]
        whole = held.where(~lack[0]).join(new.where(~lack[1]), self._same("new_", False), how)
        return whole.unionByName(held.where(lack[0]).join(new.where(lack[1]), self._same("new_", True), how))

    def _touched(self, sent: DataFrame) -> DataFrame:
        """Months that hold or get a version of the keys; of the table, keys and months are read, and it is not shuffled."""
        keys = sent.select([F.col(key).alias(f"new_{key}") for key in self.keys])
        held = self._by_key(self._rows().select(*self.keys, self.month_column), keys, "left_semi")
        return held.select(self.month_column).unionByName(sent.select(self.month_column)).distinct()

    def _order(self, prefix: str = "") -> Column:
        """What tells versions apart: the mark, NULL being the newest, then all other columns."""
        mark = F.col(f"{prefix}{self.mark_column}")
        rest = [F.col(f"{prefix}{name}") for name in self.schema.fieldNames() if name not in (*self.keys, self.mark_column)]
        return F.struct(mark.isNull().alias("unknown"), mark.alias("mark"), *[c.alias(f"c{k}") for k, c in enumerate(rest)])

    def _merged(self, held: DataFrame, sent: DataFrame, newest: bool) -> DataFrame:
        """Held and sent rows by key, the newer one of each, and for rows that are taken the version they replace."""
        names = self._full.fieldNames()
        new = sent.select(*[F.col(name).alias(f"new_{name}") for name in names], F.lit(True).alias("sent"))
        both = self._by_key(held.withColumn("held", F.lit(True)), new, "full_outer")
        older = self._order() > self._order("new_") if self.mark_column and not newest else F.lit(False)
        taken = F.coalesce(F.col("sent") & (F.col("held").isNull() | ~older), F.lit(False))
        chosen = [F.when(F.col("taken"), F.col(f"new_{name}")).otherwise(F.col(name)).alias(name) for name in names]
        went = F.when(F.col("taken") & F.col("held"), F.struct(F.lit(True).alias("held"), *self.watched)).alias("went")
        return both.withColumn("taken", taken).select(*chosen, "taken", went)

    def upsert(self, rows: DataFrame, on_change: OnChange | None = None, newest: bool = False) -> None:
        """Rows, one per key, replace older rows of their key; nothing else goes. Runs may come in any order.

        `newest` says that the rows are a stream's newest of their keys, so they replace what is there without a comparison.

        The merged months are written aside first and then take the place of their folders, so a run that dies either left the table as
        it was or is finished by the next one. In buckets nothing but the sent rows is dealt by key. If nobody watches, the months are
        written as they will lie and are moved; else what came and went is written with them and they are written once more.
        """
        self.recover(on_change)
        if not self.exists():
            self._create()
        run = uuid.uuid4().hex
        aside = f"{self.path}.pending/{run}"
        sent = self._send(rows, run, aside, newest)
        held = self._rows()
        if self.month_of:
            self._touched(sent).coalesce(1).write.parquet(f"{aside}/months")
            months = [row[0] for row in self._months(aside).collect()]  # a row per month
            held = held.where(self._is_in(months))
        merged = self._merged(held, sent, newest)
        if self.buckets and self.month_of and not self.watched and on_change is None:
            self._lay(merged, run, aside)
        else:
            merged.write.parquet(f"{aside}/rows")
        delete_path(self.spark, f"{aside}/sent")
        self.recover(on_change)

    def _beside(self, run: str, what: str) -> str:
        return f"{self.name}_{run}_{what}"

    def _send(self, rows: DataFrame, run: str, aside: str, newest: bool) -> DataFrame:
        """The sent rows as a table, in buckets like those of this one; a stream's batch that lies so already is not dealt again."""
        sent = self._in_months(rows)
        if not self.buckets:
            sent.write.parquet(f"{aside}/sent")
            return self.spark.read.schema(self._full).parquet(f"{aside}/sent")
        if not newest or rows.rdd.getNumPartitions() % self.buckets:
            sent = sent.repartition(self.buckets, *self.keys)
        self._enter(self._beside(run, "sent"), f"{aside}/sent", in_months=False)
        sent.write.insertInto(self._beside(run, "sent"))
        if newest:
            forget_shuffles(rows)
        return self.spark.table(self._beside(run, "sent"))

    def _lay(self, merged: DataFrame, run: str, aside: str) -> None:
        """Write the merged months as they will lie: a task has a bucket, so nothing is dealt. Months and marks are noted last."""
        name = self._beside(run, "laid")
        self._enter(name, f"{aside}/laid")
        merged.select(*self._full.fieldNames()).write.insertInto(name)
        mark = F.max(self.mark_column) if self.mark_column else F.lit(None).cast("timestamp_ntz")
        filled = self.spark.table(name).groupBy(self.month_column).agg(mark.alias("mark"))
        filled.coalesce(1).write.parquet(f"{aside}/filled")

    def _months(self, aside: str) -> DataFrame:
        return self.spark.read.schema(f"{self.month_column} date").parquet(f"{aside}/months")

    def recover(self, on_change: OnChange | None = None) -> None:
        """Finish runs whose rows are all written aside; forget others. Each step may be done twice."""
        for run in child_names(self.spark, f"{self.path}.pending", "*"):
            aside = f"{self.path}.pending/{run}"
            if path_exists(self.spark, f"{aside}/filled/_SUCCESS"):
                self._place(aside)
            elif path_exists(self.spark, f"{aside}/rows/_SUCCESS"):
                self._finish(run, aside, on_change)
            for what in ("sent", "laid"):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._beside(run, what)}")
            delete_path(self.spark, aside)

    def _place(self, aside: str) -> None:
        """Move the months that were laid aside to their places; those that a dead run has moved are not there any more."""
        self.exists()
        filled = self.spark.read.parquet(f"{aside}/filled").collect()  # a row per month
        for month in child_names(self.spark, f"{aside}/laid", f"{self.month_column}=*"):
            delete_path(self.spark, f"{self.path}/{month}")
            if not move_path(self.spark, f"{aside}/laid/{month}", f"{self.path}/{month}"):
                raise OSError(f"cannot move {month} of {aside} to {self.path}")
        self._drop_months({month for (month,) in self._months(aside).collect()} - {month for month, _ in filled})
        self._sync()
        self._note_mark(max((mark for _, mark in filled if mark is not None), default=None))

    def _finish(self, run: str, aside: str, on_change: OnChange | None) -> None:
        self.exists()
        went = StructType([StructField("held", BooleanType()), *[self.schema[name] for name in self.watched]])
        merged = StructType([*self._full.fields, StructField("taken", BooleanType()), StructField("went", went)])
        rows = self.spark.read.schema(merged).parquet(f"{aside}/rows")
        if on_change is not None:
            came = rows.where("taken").select(*self.watched, F.lit(1).alias("sign"))
            gone = rows.where("went.held").select(*[F.col(f"went.{name}") for name in self.watched], F.lit(-1).alias("sign"))
            on_change(run, came.unionByName(gone))
        self._insert(rows)
        filled, mark = self._months_and_mark(rows)
        if self.month_of:
            self._drop_months({month for (month,) in self._months(aside).collect()} - filled)
        self._note_mark(mark)

    def read_months(self, months: list[dt.date | None]) -> DataFrame:
        """Current rows of some months, from their folders only; None stands for the rows without a date."""
        return self._rows().where(self._is_in(months)).select(*self.schema.fieldNames())

    def _is_in(self, months: list[dt.date | None]) -> Column:
        dated = [F.lit(month) for month in months if month is not None]
        inside = F.col(self.month_column).isin(*dated) if dated else F.lit(False)
        return inside | F.col(self.month_column).isNull() if None in months else inside

    def replace_months(self, rows: DataFrame, months: list[dt.date | None]) -> None:
        """The rows are the whole new content of these months, also of those without a row. They may be read from this table."""
        if not self.exists():
            self._create()
        aside = f"{self.path}.months/{uuid.uuid4().hex}"
        self._in_months(rows).write.parquet(aside)
        rows = self.spark.read.schema(self._full).parquet(aside)
        self._insert(rows)
        self._drop_months(set(months) - self._months_and_mark(rows)[0])
        delete_path(self.spark, aside)

    def _drop_months(self, months: set[dt.date | None]) -> None:
        for month in months:
            delete_path(self.spark, f"{self.path}/{self.month_column}={month or NO_MONTH}")
        if months:
            self._sync()
