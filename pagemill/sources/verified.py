"""Updates of several tables as one: written beside what stands, read back, compared, and only then valid."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import markdown as M
from pagemill.operators import review

Tables = dict[str, DataFrame]
MARK = "_WHOLE"


@dataclass(frozen=True)
class Outcome:
    """Whether an update counts, why not, and how many rows it changed."""

    ok: bool
    why: str = ""
    changed: int = 0


class Store:
    """Tables under one folder of the shared store, in versions. A version counts from its mark on, which is written last:
    readers see all of an update or nothing of it, and one that fails half way leaves what stood before."""

    def __init__(self, spark: SparkSession, root: str, names: Iterable[str]) -> None:
        self.spark, self.root, self.names = spark, root.rstrip("/"), tuple(names)
        jvm = spark.sparkContext._jvm
        self._path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[str]:
        if not self._fs.exists(self._path()):
            return []
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._path()) if f.isDirectory())

    def current(self) -> str | None:
        """The last version that has its mark."""
        return next((v for v in reversed(self._versions()) if self._fs.exists(self._path(v, MARK))), None)

    def read(self) -> Tables:
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"no whole version under {self.root}")
        return {n: self.spark.read.parquet(f"{self.root}/{version}/{n}") for n in self.names}

    def _fingerprint(self, df: DataFrame) -> tuple:
        """Rows and a sum of their hashes: order does not count, repeats do."""
        body = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
        return tuple(df.select(F.xxhash64(body).cast("decimal(38,0)").alias("a"), F.xxhash64(F.lit(1), body).cast("decimal(38,0)").alias("b")).agg(F.count("*"), F.sum("a"), F.sum("b")).first())

    def write(self, tables: Tables) -> Outcome:
        """A version of all tables, valid if what is read back is what was to be written; else it is taken away again.

        ``tables`` may be made from the current version: it stays as it is.
        """
        if set(tables) != set(self.names):
            raise ValueError(f"a version has the tables {', '.join(self.names)}")
        past = self._versions()
        version = f"v-{int(past[-1].removeprefix('v-')) + 1 if past else 1:09d}"
        try:
            for name, df in tables.items():
                df.write.parquet(f"{self.root}/{version}/{name}")
            for name, df in tables.items():
                if self._fingerprint(self.spark.read.parquet(f"{self.root}/{version}/{name}")) != self._fingerprint(df):
                    self._fs.delete(self._path(version), True)
                    return Outcome(False, f"read-back mismatch: {name}")
            self._fs.create(self._path(version, MARK)).close()
        except Exception:
            self._fs.delete(self._path(version), True)
            raise
        return Outcome(True)

    def update(self, change: Callable[[Tables], Tables]) -> Outcome:
        """``change`` takes the tables as they stand and gives those that differ."""
        now = self.read()
        return self.write(now | change(now))

    def drop_old(self, keep: int = 2) -> None:
        """Versions before the last ``keep`` whole ones go, and what was never finished before the current one."""
        whole = [v for v in self._versions() if self._fs.exists(self._path(v, MARK))]
        for version in self._versions():
            if whole and version < whole[-keep:][0]:
                self._fs.delete(self._path(version), True)


def edit_tables(store: Store, edits: DataFrame, holders: tuple[str, ...] = ("questions", "solutions"), ledger: str | None = None) -> Outcome:
    """Markdown of tables replaced, or tables removed (null markdown), in every copy that questions and solutions hold; ids are compared without case.

    ``edits`` are ``q_id, table_id, markdown``, the latest of each. Refused as a whole: an uneven table or one of fewer than two rows, an edit whose
    table no row has. The edits go into ``ledger`` once the new version counts; ``changed`` is the number of copies.
    """
    edits = edits.withColumn("_q", F.upper(F.trim("q_id")))
    if not edits.where(F.col("markdown").isNotNull() & ~M.even_shape("markdown")).isEmpty():
        return Outcome(False, "uneven or too-short markdown table")
    now = store.read()
    held = None
    for name in holders:
        own = now[name].select(F.upper("q_id").alias("_q"), F.explode("tables.table_id").alias("table_id"))
        held = own if held is None else held.unionByName(own)
    copies = edits.join(held, ["_q", "table_id"]).count()
    if not edits.join(held, ["_q", "table_id"], "left_anti").isEmpty():
        return Outcome(False, "table not found")
    if not copies:
        return Outcome(True)
    changed = {n: review.tables_edited(now[n].withColumn("_q", F.upper("q_id")), edits, "_q").select(now[n].columns) for n in holders}
    out = store.write(now | changed)
    if out.ok and ledger:
        edits.select("q_id", "table_id", "markdown", F.when(F.col("markdown").isNull(), "table_delete").otherwise("table_edit").alias("kind"), F.current_timestamp().alias("ts")).write.mode("append").json(ledger)
    return Outcome(out.ok, out.why, copies if out.ok else 0)
