"""Layer tables over parquet, published by version.

Parquet has no MERGE or DELETE and a table cannot be overwritten while it is
read (trap T8).  Every publish therefore writes *new* folders first and
switches afterwards:

* whole tables, one or several, of any layout -> one new release
  (:mod:`strata.sources.releases`), which all names resolve through
* one partition -> ``ALTER TABLE t PARTITION (c = v) SET LOCATION '<new folder>'``
* keyed merge   -> one new folder for the touched key buckets, then each
  touched bucket's partition switched to its subfolder (:meth:`Layers.merge`)

A table without partitions is a list of folders; a partitioned one is a catalog
table of its own name per version, so that its partitions can be switched.
Readers see the old version until the switch, a failed write leaves the
table untouched, and an empty input for a partition empties exactly that
partition (the reference deletes the day first).  The folders live under the
shared folder named by ``spark.checkpoint.dir`` unless a root is given."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import loads
from strata.operators.keyed import pick_one
from strata.session import scratch_path
from strata.sources.releases import Releases


KEY_BUCKET = "key_bucket"
# Folders that a table without partitions may be spread over by appends.
MAX_FOLDERS = 64
# A table-design choice, fixed when a keyed table is created: size it so a
# bucket holds a few GB at the table's expected size (e.g. 4096 buckets for
# ~10 TB).  A merge rewrites, and a keyed insert scans, only the buckets its
# keys fall into.
DEFAULT_KEY_BUCKETS = 32


def key_bucket(keys: Sequence[str], n: int):
    """Hash bucket of a key (stable: xxhash64 with Spark's fixed seed)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of one partition value together, for a write with few files per
    folder.  A rebalance: AQE splits a hot value over several writers and
    packs small ones, without a sampling pass over the input."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


class EmptyInput(ValueError):
    """Raised when a full refresh would publish an empty table (T12)."""


def _sql_literal(v) -> str:
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


class Snapshot:
    """The tables of one release: reads of several tables agree."""

    def __init__(self, spark: SparkSession, entries: dict[str, dict]):
        self.spark, self.entries = spark, entries

    def read(self, name: str, layout: bool = False) -> DataFrame:
        """The table's rows; the ``key_bucket`` layout column of a keyed table and
        the deleted rows and positions of a change state (see
        :meth:`Layers.merge_newest`) are left out unless ``layout``."""
        e = self.entries[name]
        if "table" in e:
            # writes may come from another session (a streaming batch): drop any
            # cached file listing of the table first
            self.spark.catalog.refreshTable(e["table"])
            df = self.spark.table(e["table"])
        else:
            df = self.spark.read.schema(StructType.fromJson(e["schema"])).parquet(*e["paths"])
        if layout:
            return df
        if "order" in e:
            df = df.filter(~F.col(e["gone"]) & (F.col(e["order"]) > F.lit(e.get("cleared", -2**63)))).drop(e["order"], e["gone"])
        return df.drop(KEY_BUCKET)


class Layers:
    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str = ""):
        self.spark = spark
        self.root = (root or scratch_path(spark, "layers")).rstrip("/")
        self.prefix = prefix
        self.releases = Releases(spark, self.root)

    # naming ---------------------------------------------------------------
    def _entry(self, name: str) -> dict:
        return self.releases.current()[name]

    def table(self, name: str) -> str:
        """The catalog table of a partitioned table's current version."""
        return self._entry(name)["table"]

    def exists(self, name: str) -> bool:
        return name in self.releases.current()

    def snapshot(self) -> Snapshot:
        return Snapshot(self.spark, self.releases.current())

    def read(self, name: str, layout: bool = False) -> DataFrame:
        return self.snapshot().read(name, layout)

    def _set(self, name: str, **changes) -> None:
        """Change parts of a table's entry."""
        self.releases.commit(lambda now: {**now, name: {**now[name], **changes}})

    # publish --------------------------------------------------------------
    def _define(self, name: str, df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
        cols = [f for f in df.schema.fields if f.name not in partition_by] + \
               [df.schema[c] for c in partition_by]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols)
        t = f"{self.prefix}{name}"
        self.spark.sql(f"CREATE TABLE {t} ({ddl}) USING parquet PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}'")
        self.spark.sql(f"ALTER TABLE {t} RECOVER PARTITIONS")

    def full_refresh(self, tables: Mapping[str, DataFrame], partition_by: Mapping[str, Sequence[str]] | None = None,
                     allow_empty: bool = False, max_parallel: int = 8,
                     properties: Mapping[str, dict] | None = None) -> None:
        """Publish several tables together (S15): all new versions are
        written first -- independent tables as concurrent jobs, up to
        ``max_parallel`` at once -- and one release then names them all, also
        where columns or partitioning change.  If any write fails or an input is
        empty (refused unless ``allow_empty``), nothing is switched.  Versions
        that no kept release names are removed, entries and folders."""
        partition_by, properties = partition_by or {}, properties or {}

        def stage(name: str, df: DataFrame) -> dict:
            version = f"{name}__v{uuid.uuid4().hex[:12]}"
            folder = f"{self.root}/{version}"
            path = f"{folder}/v-0"
            w = df.write.mode("errorifexists")
            parts = list(partition_by.get(name, ()))
            if parts:
                w = by_partition(df, parts).write.mode("errorifexists").partitionBy(*parts)
            w.parquet(path)
            # emptiness is checked on the written version (footers only), so
            # the input plan runs once; nothing is switched if it is refused
            if not allow_empty and self.spark.read.schema(df.schema).parquet(path).isEmpty():
                raise EmptyInput(f"refusing to publish empty table {name}")
            if not parts:
                return {"paths": [path], "schema": df.schema.jsonValue()}
            self._define(version, df, path, parts)
            return {"table": f"{self.prefix}{version}", "paths": [folder]}

        if len(tables) > 1 and max_parallel > 1:
            with ThreadPoolExecutor(max_workers=min(len(tables), max_parallel)) as pool:
                futures = {name: pool.submit(stage, name, df) for name, df in tables.items()}
                staged = {name: f.result() for name, f in futures.items()}
        else:
            staged = {name: stage(name, df) for name, df in tables.items()}
        self.releases.commit(lambda now: {**now, **{n: {**e, **properties.get(n, {})} for n, e in staged.items()}})

    def vacuum(self, name: str) -> int:
        """Remove the folders of a partitioned table that merges and partition
        switches have left behind; no reader may still be on them.  Returns their
        number."""
        folder = self._entry(name)["paths"][0]
        listed = self.spark.sql(f"SHOW PARTITIONS {self.table(name)}").collect()
        if not listed:
            return 0
        self.spark.catalog.refreshTable(self.table(name))
        files = self.spark.table(self.table(name)).select(F.input_file_name().alias("f"))
        used = {r[0] for r in files.select(F.regexp_replace("f", "^[a-z]+:/+|/[^/]*$", "")).distinct().collect()}
        return self.releases.remove_unused(folder, {"/" + u for u in used})

    def replace_partition(self, name: str, df: DataFrame, column: str, value) -> None:
        """Static partition replace (S6, D9): the partition ``column = value``
        afterwards holds exactly ``df``'s rows for that value -- none if
        ``df`` has none."""
        rows = df.filter(F.col(column) == F.lit(value)).drop(column)
        self._switch_partition(name, rows, column, value)

    def _switch_partition(self, name: str, rows: DataFrame, column: str, value) -> None:
        """Write ``rows`` (without the partition column) to a fresh folder and
        point the partition ``column = value`` at it."""
        t = self.table(name)
        path = f"{self._new_path(name)}/{column}={value}"
        rows.write.mode("errorifexists").parquet(path)
        spec = f"PARTITION ({column} = {_sql_literal(value)})"
        self.spark.sql(f"ALTER TABLE {t} ADD IF NOT EXISTS {spec} LOCATION '{path}'")
        self.spark.sql(f"ALTER TABLE {t} {spec} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(t)

    def _new_path(self, name: str) -> str:
        """A fresh folder inside the current version of a partitioned table."""
        return f"{self._entry(name)['paths'][0]}/v-{uuid.uuid4().hex[:16]}"

    def partition_columns(self, name: str) -> list[str]:
        if "table" not in self._entry(name):
            return []
        return [c.name for c in self.spark.catalog.listColumns(self.table(name)) if c.isPartition]

    def sync_columns(self, name: str, df: DataFrame) -> None:
        """Schema sync before a load (D11, ``sync_all_columns``): columns of
        ``df`` the table lacks are added (metadata only -- files written
        before read them as NULL); data columns ``df`` no longer has are
        removed and columns of another type are cast to ``df``'s, which a
        parquet catalog table can only do by one rewrite of the table
        (partitioning and key buckets kept).  A value that does not cast fails
        the sync and leaves the table as it was."""
        cur = self.read(name, layout=True)
        parts = self.partition_columns(name)
        added = [f for f in df.schema.fields if f.name not in cur.columns]
        removed = [c for c in cur.columns if c not in df.columns and c not in parts]
        kinds = {f.name: f.dataType for f in df.schema.fields}
        retyped = {f.name: F.col(f.name).cast(kinds[f.name]) for f in cur.schema.fields
                   if f.name not in parts and kinds.get(f.name, f.dataType) != f.dataType}
        if removed or retyped:
            kept = cur.drop(*removed).withColumns(retyped)
            for f in added:
                kept = kept.withColumn(f.name, F.lit(None).cast(f.dataType))
            told = {k: v for k, v in self._entry(name).items() if k not in ("table", "paths", "schema")}
            self.full_refresh({name: kept}, partition_by={name: parts}, allow_empty=True, properties={name: told})
        elif added and parts:
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.table(name)} ADD COLUMNS ({ddl})")
        elif added:
            self._set(name, schema=StructType([*cur.schema.fields, *added]).jsonValue())

    def refresh_day(self, name: str, df: DataFrame, date_col: str, day: str, grain: str = "month",
                    sync_columns: bool = True) -> None:
        """Incremental refresh of a date-keyed fact (D9): the first run
        publishes all of ``df``; a later run replaces exactly the rows of
        ``day`` with ``df``'s rows of that day (none if it has none) -- the
        reference's delete-then-insert of the run date.

        The table is partitioned by ``trunc(date_col, grain)`` in a column
        ``<date_col>_<grain>``.  A run rewrites only the partition holding
        ``day``: that partition's other days are carried over (read with
        partition pruning), the day's rows are replaced, and the partition is
        switched to the new folder.  A month grain keeps a daily fact at twelve
        partitions a year instead of 365 small ones, for one month of the fact
        rewritten per run; ``grain='day'`` gives one partition per day.
        With ``sync_columns`` a run whose columns differ from the table's
        first syncs them (:meth:`sync_columns`), as the reference's facts do."""
        if grain not in ("day", "month", "year"):
            raise ValueError("grain must be 'day', 'month' or 'year'")
        first = dt.date.fromisoformat(day)
        part = date_col if grain == "day" else f"{date_col}_{grain}"
        staged = df if grain == "day" else df.withColumn(part, F.trunc(date_col, grain))
        if not self.exists(name):
            self.full_refresh({name: staged}, partition_by={name: [part]}, allow_empty=True)
            return
        if sync_columns:
            self.sync_columns(name, staged)
        if grain == "day":
            self.replace_partition(name, df, date_col, day)
            return
        p_value = (first.replace(day=1) if grain == "month" else first.replace(month=1, day=1)).isoformat()
        in_day = F.coalesce(F.col(date_col) == F.to_date(F.lit(day)), F.lit(False))
        cur = self.read(name)
        kept = cur.filter((F.col(part) == F.to_date(F.lit(p_value))) & ~in_day)
        rows = kept.unionByName(staged.filter(in_day).select(*cur.columns))
        self._switch_partition(name, rows.drop(part), part, p_value)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to a table without partitions: one more folder, named by the
        next release; beyond ``MAX_FOLDERS`` they become one."""
        cur = self.read(name, layout=True)
        rows = df.select(*cur.columns)
        if "table" in self._entry(name):
            rows.write.insertInto(self.table(name))
            return
        if len(self._entry(name)["paths"]) >= MAX_FOLDERS:
            self.full_refresh({name: cur.unionByName(rows)}, allow_empty=True)
            return
        path = self._write_folder(name, rows)
        self.releases.commit(lambda now: {**now, name: {**now[name], "paths": [*now[name]["paths"], path]}})

    def _write_folder(self, name: str, rows: DataFrame) -> str:
        path = f"{self.root}/{name}__v{uuid.uuid4().hex[:12]}/v-0"
        rows.write.mode("errorifexists").parquet(path)
        return path

    def append_once(self, name: str, df: DataFrame, feed: str, batch: int) -> None:
        """Add batch number ``batch`` of ``feed`` to a table without partitions, unless
        it is there: the release that adds the folder notes the number.  Beyond
        ``MAX_FOLDERS`` the folders become one."""
        entry = self.releases.current().get(name)
        if entry and entry.get("batches", {}).get(feed, -1) >= batch:
            return
        whole = entry is not None and len(entry["paths"]) >= MAX_FOLDERS
        cur = self.read(name) if entry else None
        rows = df.select(*cur.columns) if entry else df
        path = self._write_folder(name, cur.unionByName(rows) if whole else rows)

        def update(now: dict) -> dict:
            e = now.get(name) or {"paths": [], "schema": df.schema.jsonValue()}
            kept = [] if whole else e["paths"]
            return {**now, name: {**e, "paths": [*kept, path], "batches": {**e.get("batches", {}), feed: batch}}}

        self.releases.commit(update)

    def upsert(self, name: str, new: DataFrame, keys: Sequence[str],
               n_buckets: int = DEFAULT_KEY_BUCKETS) -> None:
        """Newest wins on ``keys`` (S16).  Duplicate keys inside ``new`` are
        an error, as they are for the reference's single INSERT (T17): the
        plan that computes the rows raises it.  A new table is created keyed (see
        :meth:`merge`)."""
        try:
            self.merge(name, loads.unique_on(new, keys), keys, n_buckets=n_buckets)
        except Exception as e:
            if loads.DUPLICATE_KEYS in str(e):
                raise ValueError(f"{loads.DUPLICATE_KEYS} for {name}") from e
            raise

    def _create_keyed(self, name: str, rows: DataFrame, keys: Sequence[str], n_buckets: int, **told) -> None:
        self.full_refresh({name: rows.withColumn(KEY_BUCKET, key_bucket(keys, n_buckets))},
                          partition_by={name: [KEY_BUCKET]}, allow_empty=True,
                          properties={name: {"key_buckets": int(n_buckets), **told}})

    def key_buckets(self, name: str) -> int | None:
        """Bucket count a keyed table was created with (kept in its entry, so
        every later merge hashes keys the same way), or None."""
        return self._entry(name).get("key_buckets")

    def _touched(self, name: str, keys: Sequence[str], rows: DataFrame) -> tuple[list[int], DataFrame]:
        """The bucket ids of ``rows`` (at most the table's buckets) and the stored
        rows of those buckets: untouched buckets are not read."""
        bucket = key_bucket(keys, self.key_buckets(name))
        buckets = sorted(r[0] for r in rows.select(bucket).distinct().collect())
        return buckets, self.read(name, layout=True).filter(F.col(KEY_BUCKET).isin(buckets))

    def _rewrite(self, name: str, fresh: DataFrame, buckets: Sequence[int]) -> None:
        """Make ``fresh`` the contents of ``buckets``: written in one job, then each
        bucket's partition switched; a bucket left empty is dropped."""
        path = self._new_path(name)
        by_partition(fresh, [KEY_BUCKET]).write.mode("errorifexists").partitionBy(KEY_BUCKET).parquet(path)
        # the buckets that got rows: at most n_buckets values, from the layout column alone
        written = {r[0] for r in self.spark.read.schema(fresh.schema).parquet(path).select(KEY_BUCKET).distinct().collect()}
        t = self.table(name)
        for b in buckets:
            spec = f"PARTITION ({KEY_BUCKET} = {b})"
            if b in written:
                loc = f"{path}/{KEY_BUCKET}={b}"
                self.spark.sql(f"ALTER TABLE {t} ADD IF NOT EXISTS {spec} LOCATION '{loc}'")
                self.spark.sql(f"ALTER TABLE {t} {spec} SET LOCATION '{loc}'")
            else:
                self.spark.sql(f"ALTER TABLE {t} DROP IF EXISTS {spec}")
        self.spark.catalog.refreshTable(t)

    def merge(self, name: str, rows: DataFrame, keys: Sequence[str], remove: DataFrame | None = None,
              n_buckets: int = DEFAULT_KEY_BUCKETS, materialized: bool = False) -> None:
        """Keyed merge without MERGE (S12, S16): ``rows`` replace the stored
        rows of their keys, keys in ``remove`` are deleted, every other key
        stays.  ``rows`` must be unique on ``keys``.

        A table created here is partitioned by ``key_bucket =
        pmod(xxhash64(keys), n_buckets)``, and its entry keeps ``n_buckets``.  A merge then reads only the
        buckets its keys fall into (their ids, at most ``n_buckets``, become
        a partition filter on the scan), writes those
        buckets' new contents to a fresh folder in one job, and points just
        those partitions at it; a bucket left empty is dropped.  A small change
        batch against a large table rewrites a few buckets instead of the
        table.  Each key lives in one bucket, so a failure between partition
        switches leaves every key at its old or its new version, and running
        the merge again completes it.  A table without the bucket column is
        rewritten whole.  ``materialized`` says the inputs are already
        checkpointed (otherwise they are, once, here)."""
        keys = list(keys)
        if not materialized:
            # read several times below (bucket ids, new rows): compute once
            rows = rows.checkpoint(eager=True)
            remove = remove.select(*keys).checkpoint(eager=True) if remove is not None else None
        touched_keys = rows.select(*keys)
        if remove is not None:
            touched_keys = touched_keys.unionByName(remove.select(*keys))
        touched_keys = touched_keys.distinct()
        if not self.exists(name):
            live = rows if remove is None else rows.join(remove.select(*keys), keys, "left_anti")
            self._create_keyed(name, live, keys, n_buckets)
            return
        if self.key_buckets(name) is None:
            cur = self.read(name)
            kept = cur.join(touched_keys, keys, "left_anti")
            self.full_refresh({name: kept.unionByName(rows.select(*cur.columns))}, allow_empty=True)
            return
        buckets, cur = self._touched(name, keys, touched_keys)
        if buckets:
            fresh = rows.withColumn(KEY_BUCKET, key_bucket(keys, self.key_buckets(name))).select(*cur.columns)
            self._rewrite(name, cur.join(touched_keys, keys, "left_anti").unionByName(fresh), buckets)

    def merge_newest(self, name: str, rows: DataFrame, keys: Sequence[str], order: str, gone: str,
                     final_below: int | None = None, n_buckets: int = DEFAULT_KEY_BUCKETS) -> None:
        """Keyed state that keeps, beside each row, the position ``order`` it is from
        and whether it was deleted (``gone``; such a row only remembers the position):
        of the stored row and the row in ``rows`` (unique on ``keys``) the larger
        position stays.  One job reads and rewrites the touched buckets.

        What a truncate has cleared (:meth:`clear`) is dropped from them, and so are
        deleted rows below ``final_below``: a position that no event can be under
        any more."""
        keys, order_col = list(keys), F.col(order)
        rows = rows.checkpoint(eager=True)  # read for its bucket ids, too
        if not self.exists(name):
            self._create_keyed(name, rows, keys, n_buckets, order=order, gone=gone)
            return
        buckets, cur = self._touched(name, keys, rows)
        if not buckets:
            return
        fresh = rows.withColumn(KEY_BUCKET, key_bucket(keys, self.key_buckets(name))).select(*cur.columns)
        newest = pick_one(cur.unionByName(fresh), keys, [order], keep="last").select(*cur.columns)
        newest = newest.filter(order_col > F.lit(self._entry(name).get("cleared", -2**63)))
        if final_below is not None:
            newest = newest.filter(~(F.col(gone) & (order_col < F.lit(final_below))))
        self._rewrite(name, newest, buckets)

    def cleared(self, name: str) -> int | None:
        """Position of the newest truncate of a state table, if there was one."""
        return self._entry(name).get("cleared") if self.exists(name) else None

    def clear(self, name: str, position: int) -> None:
        """Empty a state table up to ``position``: one number in its entry, which
        reads filter by and merges drop by."""
        self._set(name, cleared=int(position))

    def put_first(self, name: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                  n_buckets: int = DEFAULT_KEY_BUCKETS) -> None:
        """First-wins load (S3): of the stored row and the row in ``rows`` (unique on
        ``keys``) the smaller position ``order`` stays.

        The keys and positions of the touched buckets are joined once, and split the
        rows: keys the table lacks are appended, which adds about their own bytes;
        only where a late row beats a stored one is its bucket rewritten.  Rows that
        are stored already, of a batch run again, are neither."""
        keys, position = list(keys), F.struct(*order)
        if not self.exists(name):
            self._create_keyed(name, rows, keys, n_buckets)
            return
        rows = rows.checkpoint(eager=True)
        buckets, cur = self._touched(name, keys, rows)
        if not buckets:
            return
        held = cur.select(*keys, position.alias("_held"))
        new = (rows.join(held, keys, "left").filter(F.col("_held").isNull() | (position < F.col("_held")))
               .withColumn("_beats", F.col("_held").isNotNull()).drop("_held").checkpoint(eager=True))
        late = new.filter("_beats").drop("_beats")
        if not late.isEmpty():
            self.merge(name, late, keys, materialized=True)
        fresh = new.filter("NOT _beats").withColumn(KEY_BUCKET, key_bucket(keys, self.key_buckets(name)))
        by_partition(fresh.select(*cur.columns), [KEY_BUCKET]).write.insertInto(self.table(name))

    def insert_if_absent(self, name: str, new: DataFrame, keys: Sequence[str], order: Sequence | None = None,
                         n_buckets: int = DEFAULT_KEY_BUCKETS, distinct: bool = True) -> None:
        """Append the rows whose key the table lacks (S3 first-wins, S17); with
        ``order``, the first row per key inside ``new`` is the one kept.  Without
        ``distinct`` all rows of an absent key are appended.

        A table created here is keyed like :meth:`merge`: the key check then
        scans only the key columns of the buckets ``new``'s keys fall into
        (their ids, at most ``n_buckets``, are a partition filter), and the
        new rows are appended into those buckets' partitions."""
        keys = list(keys)

        def absent(target: DataFrame) -> DataFrame:
            if distinct:
                return loads.insert_if_absent(target, new, keys, order)
            return new.join(target.select(*keys).distinct(), keys, "left_anti")

        if not self.exists(name):
            self._create_keyed(name, absent(new.limit(0)), keys, n_buckets)
        elif self.key_buckets(name) is None:
            self.append(name, absent(self.read(name)))
        else:
            buckets, cur = self._touched(name, keys, new)
            if not buckets:
                return
            # the rows depend on the table they are appended to: cut the lineage
            # with a reliable checkpoint (shared folder) before writing into it
            rows = absent(cur).withColumn(KEY_BUCKET, key_bucket(keys, self.key_buckets(name)))
            rows = rows.checkpoint(eager=True).select(*cur.columns)
            # one writer per bucket (a hot bucket may span tasks): few files
            by_partition(rows, [KEY_BUCKET]).write.insertInto(self.table(name))
