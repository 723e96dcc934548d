"""Sources: JSON lines, Markdown folders, override files, TOML settings, environment files, prompts."""

from __future__ import annotations

import os
import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines by an explicit schema; a line that is no such object fails the read, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_ordered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As ``read_jsonl`` with source_file and line_no. One row per file is read whole, so that line numbers are those
    of the file; meant for files of manifests and shards, not for one huge file."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source_file"), "value")
    lines = raw.select("source_file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line")).filter(F.trim("line") != "")
    parsed = lines.withColumn("r", F.from_json("line", schema, {"mode": "FAILFAST"}))
    return parsed.select("source_file", (F.col("line_no") + 1).alias("line_no"), "r.*")


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(source_path, text) of a Markdown file or of all *.md below a folder; any other file is an error."""
    p = Path(path)
    if p.is_file() and p.suffix.lower() != ".md":
        raise ValueError(f"no Markdown file: {path}")
    only = {} if p.is_file() else {"pathGlobFilter": "*.md"}
    root = (p if p.is_dir() else p.parent).resolve().as_posix()
    name = F.regexp_replace(F.input_file_name(), r"^file:/*", "/")
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True, **only).select(F.ltrim(F.replace(F.url_decode(name), F.lit(root), F.lit("")), F.lit("/")).alias("source_path"), F.col("value").alias("text"))


def source_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), "modificationTime")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(alias, canonical_name) of an override file of {canonical_name, aliases}; an alias of two names is an error."""
    rows = read_jsonl(spark, path, "canonical_name string, aliases array<string>")
    out = rows.select(F.explode("aliases").alias("alias"), "canonical_name").distinct()
    bad = out.groupBy("alias").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(5).collect()
    if bad:
        raise ValueError(f"aliases with several names: {[r['alias'] for r in bad]}")
    return out


def csv_ids(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Distinct values of one column of CSV files with a header, line breaks inside quotes included."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).select(column).distinct()


def bulk_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct _id of the action lines of bulk files."""
    return spark.read.text(path).select(F.get_json_object("value", "$.index._id").alias("id")).filter(F.col("id").isNotNull()).distinct()


def read_settings(path: str, bounds: dict[str, tuple[float, float]] | None = None) -> dict:
    """A TOML file; relative values of keys ending in _path or _dir are taken from its folder, numbers are held
    against ``bounds`` (dotted name -> least, most)."""
    base = Path(path).resolve().parent

    def walk(x: dict, at: str) -> dict:
        out = {}
        for k, v in x.items():
            name = f"{at}{k}"
            if isinstance(v, dict):
                out[k] = walk(v, name + ".")
            elif isinstance(v, str) and k.endswith(("_path", "_dir")) and v and not os.path.isabs(v):
                out[k] = str(base / v)
            else:
                out[k] = v
            if bounds and name in bounds and not bounds[name][0] <= v <= bounds[name][1]:
                raise ValueError(f"{name} must lie in {bounds[name]}, is {v}")
        return out

    return walk(tomllib.loads(Path(path).read_text(encoding="utf-8")), "")


def load_environment(path: str) -> dict[str, str]:
    """Sets what an environment file names and the environment lacks; returns what was set."""
    done = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            k, v = (x.strip() for x in line.split("=", 1))
            v = v.strip("'\"")
            if k not in os.environ:
                os.environ[k] = done[k] = v
    return done


def load_prompt(folder: str, name: str) -> str:
    """A prompt file below the folder; a name that leads out of it is refused."""
    base = Path(folder).resolve()
    p = (base / name).resolve()
    if base not in p.parents:
        raise ValueError(f"outside the prompt folder: {name}")
    return p.read_text(encoding="utf-8")
