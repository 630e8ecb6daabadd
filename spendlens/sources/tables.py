"""The stored star schema: parquet folders, facts partitioned by day or by month.

Days suit volumes where one day fills files; months keep thin histories from falling apart into
thousands of tiny files. Either way rows keep their `date_key`, and slices prune partitions.

Every run writes its tables to folders of its own (`{table}/run=ID/...`). Which folders make up the
star schema is said by the manifest, a small table of which each version is one file: a run is
published by writing the next version, which appears at once or not at all. Readers resolve the
newest version when they open the tables, so they see a load whole or not at all, and a run that
fails at any point leaves its folders behind and the stored tables as they were. Folders that no
version before the last names are dropped after the next publication.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from spendlens.functions.columns import norm
from spendlens.schemas import ADDED, DIMENSIONS, FACTS, PERIODIC, RUN_LOG, STORED_KEYS, TABLES
from spendlens.session import BROADCAST_ROWS


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows. Known to be empty at planning time, so joins with it disappear."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)


class Tables:
    """The tables of one star schema by name, read on first use."""

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        frames: dict[str, DataFrame] | None = None,
        visible: DataFrame | None = None,
        newest: Callable[[str], DataFrame] | None = None,
        small: frozenset[str] = frozenset(),
    ):
        self._load = load
        self._newest = newest
        self._frames = dict(frames or {})
        self._visible = visible
        self._small = small - set(self._frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if self._visible is not None and (name in FACTS or name == "dim_user"):
            return self.whole(name).join(self._visible, "user_key", "left_semi")
        if self._visible is not None and name in ADDED:
            rows = self.whole(name)
            return rows.join(self._visible, norm(rows["user_login"]) == F.col("user_key"), "left_semi")
        return self.whole(name)

    @property
    def is_restricted(self) -> bool:
        return self._visible is not None

    def whole(self, name: str) -> DataFrame:
        """The table without restriction, for figures that show no user."""
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def replace(self, **frames: DataFrame) -> Tables:
        """The same star schema with some tables swapped."""
        return Tables(self._load, {**self._frames, **frames}, self._visible, self._newest, self._small)

    def restricted(self, visible: DataFrame) -> Tables:
        """The same star schema as someone sees it who may see these users (user_key): every table
        that holds users is cut to them, whatever a report shows of it."""
        return Tables(self._load, self._frames, visible.select("user_key").distinct(), self._newest, self._small)

    def small(self, name: str) -> bool:
        """Whether the stored table was counted and has few enough rows to be sent to every task."""
        return name in self._small

    def newest(self, name: str) -> DataFrame:
        """The newest stored partition of a fact, without restriction; all of it where none is known."""
        if self._newest is None or name in self._frames:
            return self.whole(name)
        return self._newest(name)


#: Rows of a part that a task sorts in memory, however many there are in all.
PART_ROWS = 250_000


def deal(df: DataFrame, keys: Iterable[str], rows: int) -> DataFrame:
    """The frame, of about so many rows, in ranges of its keys. Grouping by these keys or by more needs no
    further exchange. Beyond a few parts their number follows the rows: adaptive merging goes by compressed
    bytes and makes parts that sorts have to spill."""
    parts = rows // PART_ROWS
    return df.repartitionByRange(parts, *keys) if parts > 8 else df.repartitionByRange(*keys)


#: Rows worth a part of their own while there are fewer parts than shuffle partitions.
_LEAST_ROWS = 20_000
#: The part that `deal_days` puts a row into.
RANGE = "_range"
_HASHES = 1 << 20
#: A calendar (of 372 days a year) that is listed; days that lie further apart are dealt by sampled ranges.
_LONGEST = 372 * 200


def month_of(day: str) -> Column:
    return F.floor(F.col(day) / 100).cast("int")


def rows_by_day(*frames: DataFrame) -> dict[int, int]:
    """Rows of each day, of all frames: a list no longer than the calendar."""
    days = reduce(DataFrame.union, [df.select("date_key") for df in frames]).filter("date_key is not null")
    return {r["date_key"]: r["rows"] for r in days.groupBy("date_key").agg(F.count("*").alias("rows")).collect()}


def deal_days(df: DataFrame, keys: Iterable[str], days: dict[int, int]) -> DataFrame:
    """The frame, of about so many rows each day, in even parts (`RANGE`) that follow each other by day; where a part
    ends within a day, hashes of the other keys say on which side a row is. As the days are counted, rows are not
    sampled, which would make each of them twice. Grouping by the part and these keys needs no further exchange."""
    total, rest = sum(days.values()), [k for k in keys if k != "date_key"]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, total // PART_ROWS, min(width, total // _LEAST_ROWS))
    spread = F.pmod(F.xxhash64(*rest), F.lit(_HASHES))
    part = F.pmod(spread, F.lit(parts))  # of rows without a day
    index = {day: day // 10000 * 372 + day // 100 % 100 * 31 + day % 100 for day in days}
    first = min(index.values(), default=0)
    if max(index.values(), default=0) - first > _LONGEST:
        return deal(df, keys, total)
    if days:
        starts, counts = ([0] * (max(index.values()) - first + 1) for _ in range(2))
        before = 0
        for day in sorted(days):
            starts[index[day] - first], counts[index[day] - first] = before, days[day]
            before += days[day]
        day = F.col("date_key")
        at = (day / 10000).cast("int") * 372 + (day / 100).cast("int") % 100 * 31 + day % 100 - first
        # one text each: a literal for each day would be thousands of calls
        starts, counts = (F.split(F.lit(",".join(map(str, of))), ",").cast("array<bigint>") for of in (starts, counts))
        place = F.get(starts, at) + F.get(counts, at) * (spread / _HASHES)
        part = F.coalesce(F.floor(place * parts / total), part)
    month = PERIODS["month"]  # follows from the day, so it does not move
    moved = df.drop(month).withColumn(RANGE, F.least(part, F.lit(parts - 1)).cast("int")).repartitionById(parts, RANGE)
    return moved.withColumn(month, month_of("date_key")) if month in df.columns else moved


def grouped_by(df: DataFrame, keys: Iterable[str]) -> list[str]:
    """These keys, with the month before them and the part of `deal_days` behind, where rows have one: sorted so for a
    group or a window, rows lie as they are stored and are not sorted again."""
    keys = list(keys)
    return [*(c for c in (PERIODS["month"],) if c in df.columns), *keys, *(c for c in (RANGE,) if c in df.columns)]


def write_all(jobs: Iterable[Callable[[], None]], at_once: int = 8) -> None:
    """Run independent writes side by side, so that small ones do not idle the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


PERIODS = {"day": "date_key", "month": "month_key"}
#: Names, digits and sparse bitmaps take far fewer bytes with it than with Spark's default.
COMPRESSION = {"compression": "zstd"}


class WarehouseMissing(RuntimeError):
    """The folder holds no published star schema."""


_MANIFEST = "version bigint, table string, period int, path string, partition string, rows bigint"
#: Parquet's own filters, as large as the distinct users of a row group need, to a bound.
USER_FILTER = {
    "parquet.bloom.filter.enabled#user_key": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(1 << 20),
}


class Warehouse:
    """The folder of one star schema. `period` is fixed by the first load that publishes."""

    def __init__(self, spark: SparkSession, root: str, period: str = "day"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition = PERIODS[period]

    # ------------------------------------------------------------------ places

    def run_path(self, run_id: str, table: str) -> str:
        """Where a run writes: tables into a version of their own, the rest into its work folder."""
        if table in TABLES:
            return f"{self.root}/{table}/run={run_id}"
        return f"{self.root}/_runs/{run_id}/{table}"

    def _manifest(self) -> list[Row]:
        """All known versions: a row for each dimension and each period of each fact."""
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _published(self) -> tuple[int, dict[str, dict[int | None, str]], dict[str, int]]:
        """The newest version: table -> period (None for a dimension) -> folder below the root; and the
        rows of the dimensions that were counted."""
        rows = self._manifest()
        newest = max((r.version for r in rows), default=0)
        parts: dict[str, dict[int | None, str]] = {}
        sizes: dict[str, int] = {}
        for r in rows:
            if r.version == newest:
                if r.partition != self.partition:
                    raise ValueError(f"{self.root} is partitioned by {r.partition}, not {self.partition}.")
                if r.table:
                    parts.setdefault(r.table, {})[r.period] = r.path
                    if r.rows is not None:
                        sizes[r.table] = r.rows
        return newest, parts, sizes

    # ------------------------------------------------------------------ periods

    def period(self) -> Column:
        """The partition a row belongs to."""
        if self.partition == "month_key":
            return month_of("date_key")
        return F.col("date_key")

    def periods(self, df: DataFrame | dict[int, int]) -> list[int]:
        """The partitions that a frame, or days that were counted, touch: a list no longer than the calendar."""
        if isinstance(df, dict):
            return sorted({day // 100 if self.partition == "month_key" else day for day in df})
        touched = df.filter("date_key is not null").select(self.period().alias("period"))
        return sorted(r.period for r in touched.distinct().collect())

    def periods_between(self, first_key: int, last_key: int) -> list[int]:
        """The stored partitions that hold days from the first to the last."""
        scale = 100 if self.partition == "month_key" else 1
        stored = {p for table, parts in self._published()[1].items() if table in PERIODIC for p in parts}
        return sorted(p for p in stored if first_key // scale <= p <= last_key // scale)

    def in_periods(self, df: DataFrame, periods: list[int]) -> DataFrame:
        """Rows of these partitions of a stored fact; the others are not read."""
        return df.filter(F.col(self.partition).isin(periods))

    def not_in_periods(self, df: DataFrame, periods: list[int]) -> DataFrame:
        return df.filter(~F.col(self.partition).isin(periods))

    # ------------------------------------------------------------------ reading

    def schema(self, table: str) -> StructType:
        schema = TABLES[table]
        if table in PERIODIC and self.partition not in schema.names:
            schema = StructType([*schema.fields, StructField(self.partition, IntegerType())])
        return schema

    def _read(self, table: str, paths: list[str]) -> DataFrame:
        read = self.spark.read.schema(self.schema(table)).option("basePath", f"{self.root}/{table}")
        return read.parquet(*(f"{self.root}/{p}" for p in paths)).select(*self.schema(table).names)

    def _read_log(self, table: str) -> DataFrame:
        try:
            return self.spark.read.schema(TABLES[table]).parquet(f"{self.root}/{table}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, TABLES[table])

    def read_run(self, run_id: str, table: str, schema: StructType | None = None) -> DataFrame:
        path = self.run_path(run_id, table)
        return self.spark.read.schema(schema or self.schema(table)).parquet(path)

    def tables(self, new: bool = False) -> Tables:
        """The newest published version. Only a first load (`new`) may find none."""
        version, parts, sizes = self._published()
        if not version and not new:
            raise WarehouseMissing(f"{self.root} holds no published star schema.")

        def read(table: str) -> DataFrame:
            if table in RUN_LOG:
                return self._read_log(table)
            if not parts.get(table):
                return empty(self.spark, self.schema(table))
            return self._read(table, sorted(parts[table].values()))

        def newest(table: str) -> DataFrame:
            periods = parts.get(table)
            return self._read(table, [periods[max(periods)]]) if periods else empty(self.spark, self.schema(table))

        small = frozenset(t for t, rows in sizes.items() if rows <= BROADCAST_ROWS)
        return Tables(read, newest=newest, small=small)

    # ------------------------------------------------------------------ writing

    def write_run(self, run_id: str, table: str, df: DataFrame, dealt: bool = False) -> None:
        """Materialise a table of this run. Facts are split evenly by range over their whole key,
        so a day or a user with most of the rows still becomes many files, each sorted by user. Files of a
        month hold most users each, so least and greatest user tell nothing: a bloom filter of each row
        group lets a user's report pass over those without the user. Rows that come `dealt` lie in ranges already.
        Other partitions of a repeated attempt are overwritten as well."""
        path = self.run_path(run_id, table)
        if table in PERIODIC:
            keys = STORED_KEYS[table]
            user = ["user_key"] if "user_key" in keys else []
            names = TABLES[table].names
            if dealt and self.partition in df.columns:
                rows = df.select(*dict.fromkeys([*names, self.partition]))
            else:
                rows = df.select(*names).withColumn(self.partition, self.period())
            (
                (rows if dealt else rows.repartitionByRange(*keys))
                .sortWithinPartitions(self.partition, "date_key", *user)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .options(**COMPRESSION, **(USER_FILTER if user else {}))
                .partitionBy(self.partition)
                .parquet(path)
            )
        else:
            df.write.mode("overwrite").options(**COMPRESSION).parquet(path)

    def publish(self, run_id: str, tables: dict[str, list[int] | None]) -> None:
        """Make a run's tables part of the star schema, all in one step.

        Dimensions are replaced whole, and so are rows that loads add (`billing_orphans`) when they come
        with an empty list; else they are added to. Of a fact, the periods that the run wrote are replaced, and
        those of the given ones that it left empty are dropped; no file is copied."""
        version, parts, sizes = self._published()

        wrote: dict[str, list[int]] = {}

        def count(table: str) -> None:
            written = self.read_run(run_id, table)
            if table in PERIODIC:
                wrote[table] = sorted(r[0] for r in written.select(self.partition).distinct().collect())
            else:
                sizes[table] = written.count()

        write_all(lambda t=table: count(t) for table in tables)
        for table, touched in tables.items():
            folder = self.run_path(run_id, table).removeprefix(f"{self.root}/")
            if table in ADDED:
                parts[table] = (parts.get(table, {}) if touched is None else {}) | {version + 1: folder}
                continue
            if table not in PERIODIC:
                parts[table] = {None: folder}
                continue
            kept = {p: path for p, path in parts.get(table, {}).items() if p not in (touched or [])}
            parts[table] = kept | {p: f"{folder}/{self.partition}={p}" for p in wrote[table]}
        rows = [
            (version + 1, t, p, path, self.partition, sizes.get(t))
            for t, own in parts.items() for p, path in own.items()
        ]
        # an own row keeps the version and its partitioning when no table has a row
        rows.append((version + 1, None, None, None, self.partition, None))
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("error").parquet(f"{self.root}/manifest/v={version + 1}")
        self._drop_superseded(version + 1)

    def _drop_superseded(self, newest: int) -> None:
        """Drop what only versions before the last two name; readers of the last one go on."""
        rows = self._manifest()
        live = {r.path for r in rows if r.version >= newest - 1}
        for path in sorted({r.path for r in rows if r.version < newest - 1 and r.path} - live):
            self._drop(f"{self.root}/{path}")
        for version in sorted({r.version for r in rows if r.version < newest - 1}):
            self._drop(f"{self.root}/manifest/v={version}")

    def end_run(self, run_id: str) -> None:
        """Forget the intermediate results of a published run."""
        self._drop(f"{self.root}/_runs/{run_id}")

    def _drop(self, path: str) -> None:
        """Deleting is the one thing that no data source does; without a driver JVM files stay."""
        jvm = getattr(self.spark, "_jvm", None)
        if jvm is not None:
            jpath = jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jpath, True)

    def append(self, table: str, df: DataFrame) -> None:
        """Add to a log, which every run does for itself, published or not."""
        df.select(*TABLES[table].names).write.mode("append").parquet(f"{self.root}/{table}")

    def grant(self, access: DataFrame, run_id: str) -> None:
        """Replace the stored grants (principal_name, cost_center)."""
        self.write_run(run_id, "report_access", access.select(*TABLES["report_access"].names))
        self.publish(run_id, {"report_access": None})


def read_tables(spark: SparkSession, root: str, period: str = "day") -> Tables:
    """The reporting source: every stored table of a warehouse folder."""
    return Warehouse(spark, root, period).tables()
