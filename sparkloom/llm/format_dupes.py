"""Duplicates hidden by formatting: an incremental ledger of canonical-key counts."""

from __future__ import annotations

import atexit
import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators.skew import salted_join
from sparkloom.runtime import materialise, remove_path, shared_dir

#: What a response may hold inside its frame: the types are those of the fields that are compared.
_FRAME = (
    "r array<struct<relations:array<struct<subject:string,predicate:string,object:string>>>>, e string, _broken string"
)
_STRICT = {"columnNameOfCorruptRecord": "_broken", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def letters_and_digits(text: Column) -> Column:
    """The letters and digits in order, letter case aside."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


def with_single_relation(df: DataFrame, response: str, out: str) -> DataFrame:
    """``df`` with ``out``, a STRUCT<subject, predicate, object>, of a response that is valid JSON, a code fence aside, and
    holds exactly one relation; null for any other text. Strict JSON: what follows the value makes it invalid.

    A text is parsed once, inside ``{"r":[ ], "e": }``. The parser stops after the first value, so a text with anything after
    its value (or with brackets that close the frame) loses the end mark e, which is the text's own hash, or has not
    one element in r. The fence is cut off by a pattern only where a text begins with one."""
    body, parsed = "_body", "_parsed"
    fenced = F.ltrim(F.col(response)).startswith("```") | F.col(response).rlike(r"\A\s*```")
    plain = F.when(fenced, F.regexp_replace(F.col(response), r"(?s)\A\s*```[A-Za-z0-9_-]*\s*(.*?)\s*```\s*\z", "$1")).otherwise(F.col(response))
    mark = F.xxhash64(body).cast("string")
    framed = F.from_json(F.concat(F.lit('{"r":['), F.col(body), F.lit('],"e":"'), mark, F.lit('"}')), _FRAME, _STRICT)
    first = F.col(f"{parsed}.r")[0]
    whole = F.col(f"{parsed}._broken").isNull() & (F.col(f"{parsed}.e") == mark) & (F.size(f"{parsed}.r") == 1) & (F.size(first["relations"]) == 1)
    return df.withColumn(body, plain).withColumn(parsed, framed).withColumn(out, F.when(whole, first["relations"][0])).drop(body, parsed)


def canonical_key(group: Column, fields: list[Column]) -> Column:
    """SHA-256 of the group and the letters and digits of every field; null if any part is null."""
    sep = F.lit("\x1f")
    parts = [group.cast("string")]
    for f in fields:
        parts += [sep, letters_and_digits(f)]
    return F.sha2(F.concat(*parts), 256)


def aggregate_batch(batch: DataFrame) -> DataFrame:
    """(key, copies, first_id) of rows (key, row_id); combined by hash before the shuffle."""
    return batch.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("row_id").alias("first_id"))


class Ledger:
    """Bucketed table key -> copies, earliest representative, kept under a name in the shared folder and opened again by it.

    ``add`` aggregates a new batch and full-outer-joins it with the ledger. Both sides hash ``key`` into the
    same buckets, so a ledger bucket meets only its part of the batch and the ledger is never shuffled. Only buckets that the
    batch touches are written; the files of the others are moved to the new version. A small pointer file names the current
    version and is replaced in one step once the new one is whole; moves broken off by a failure are finished
    when the ledger is opened. ``buckets`` is fixed when a ledger is made (unless given, twice the cores)."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, folder: str | None = None):
        if not re.fullmatch(r"[A-Za-z0-9_]+", name):
            raise ValueError("a ledger's name holds letters, digits and underscores")
        self.spark, self.name = spark, name
        self.root = f"{(folder or shared_dir(spark)).rstrip('/')}/ledgers/{name}"
        self.fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        state = self._load()
        self.buckets = state["buckets"] if state else buckets or 2 * spark.sparkContext.defaultParallelism
        self.version = state["version"] if state else 0
        if state and state.get("from"):
            self._finish(state)

    def _path(self, p: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(p)

    def _folder(self, version: int) -> str:
        return f"{self.root}/v{version}"

    def _load(self) -> dict | None:
        p = self._path(f"{self.root}/current.json")
        if not self.fs.exists(p):
            return None
        source = self.fs.open(p)
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def _save(self, state: dict) -> None:
        new, now = self._path(f"{self.root}/current.new"), self._path(f"{self.root}/current.json")
        target = self.fs.create(new, True)
        target.write(json.dumps(state).encode())
        target.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(new, now, options)

    def _finish(self, state: dict) -> None:
        """Moves the files of untouched buckets to the current version, then drops the one before. May be run again."""
        touched, old = set(state["touched"]), self._path(self._folder(state["from"]))
        for f in self.fs.listStatus(old) if self.fs.exists(old) else []:
            file = f.getPath().getName()
            bucket = re.search(r"_(\d{5})(?:\.c\d+)?\.", file)
            if bucket and not file.startswith((".", "_")) and int(bucket.group(1)) not in touched:
                to = self._path(f"{self._folder(state['version'])}/{file}")
                if not self.fs.exists(to) and not self.fs.rename(f.getPath(), to):
                    raise OSError(f"could not move {file}")
        remove_path(self.spark, self._folder(state["from"]))
        self._save({"version": state["version"], "buckets": state["buckets"]})

    def _table(self, version: int) -> str:
        return f"ledger_{self.name}_v{version}"

    def read(self) -> DataFrame:
        """Rows (key, copies, first_id) of the current version."""
        if not self.version:
            return self.spark.createDataFrame([], "key string, copies long, first_id long")
        table = self._table(self.version)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (key STRING, copies BIGINT, first_id BIGINT) USING parquet "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self._folder(self.version)}'"
        )
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table)

    def add(self, batch: DataFrame) -> None:
        """Counts a batch of rows (key, row_id). Null keys are not entered; an empty batch changes nothing."""
        bucket = F.pmod(F.hash("key"), F.lit(self.buckets))  # the hash by which Spark deals rows to buckets
        fresh = aggregate_batch(batch.filter(F.col("key").isNotNull()))
        # at most as many numbers as buckets
        touched = sorted(r[0] for r in batch.filter(F.col("key").isNotNull()).select(bucket.alias("b")).distinct().collect())
        if not touched:
            return
        old, new = self.version, fresh
        if old:
            rows = self.read().select("key", F.col("copies").alias("c0"), F.col("first_id").alias("f0"))
            if len(touched) < self.buckets:
                rows = rows.filter(bucket.isin(touched))
            new = rows.join(fresh, "key", "full_outer").select(
                "key",
                (F.coalesce("c0", F.lit(0)) + F.coalesce("copies", F.lit(0))).alias("copies"),
                F.least("f0", "first_id").alias("first_id"),
            )
        version = old + 1
        table, path = self._table(version), self._folder(version)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_path(self.spark, path)  # what a failed run left
        # rows arrive hashed by key; one file per task and bucket
        new.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(table)
        self.version = version
        if old:
            state = {"version": version, "buckets": self.buckets, "from": old, "touched": touched}
            self._save(state)
            self._finish(state)
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(old)}")
        else:
            self._save({"version": version, "buckets": self.buckets})

    def remove(self) -> None:
        """Drops the ledger with its files."""
        if self.version:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(self.version)}")
        remove_path(self.spark, self.root)


def _remove_quietly(ledger: Ledger) -> None:
    try:
        ledger.remove()
    except Exception:  # noqa: BLE001  the session may have ended; its folder goes with it
        return


def duplicate_ledger(records: DataFrame, key: str, row_id: str, batch: Column, ledger: Ledger | None = None) -> tuple[DataFrame, DataFrame]:
    """(ledger, members): counts per canonical key, entered batch by batch, and the keyed rows.

    ``batch`` names the batch of a row; batches must be few (they are listed on the driver) and are entered in
    order, the null batch first. Without a ``ledger`` to add to, a new one serves and is dropped when the session's process ends. Rows with a null key are in neither result. Repeated rows of one row id
    count once. Empty records give an empty ledger.
    """
    keyed = (
        records.select(F.col(key).alias("key"), F.col(row_id).alias("row_id"), batch.alias("batch"))
        .filter(F.col("key").isNotNull() & F.col("row_id").isNotNull())
        .groupBy("row_id", "key").agg(F.min("batch").alias("batch"))
    )
    members = materialise(keyed, "canonical-keys")
    if ledger is None:
        ledger = Ledger(records.sparkSession, f"session_{uuid.uuid4().hex}")
        atexit.register(_remove_quietly, ledger)
    for (b,) in sorted(members.select("batch").distinct().collect(), key=lambda r: (r[0] is not None, r[0])):
        ledger.add(members.filter(F.col("batch").eqNullSafe(F.lit(b))))
    return ledger.read(), members.drop("batch")


def copies(ledger: DataFrame, members: DataFrame) -> DataFrame:
    """(keep_id, copy_id): the earliest representative of each key with each of its other rows."""
    several = ledger.filter(F.col("copies") > 1).select("key", F.col("first_id").alias("keep_id"))
    return (
        salted_join(members, several, ["key"], F.col("row_id"))
        .filter(F.col("row_id") != F.col("keep_id"))
        .select("keep_id", F.col("row_id").alias("copy_id"))
    )
