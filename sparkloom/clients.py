"""Model clients behind small interfaces, applied per partition; everything else is testable with stubs."""

from __future__ import annotations

import ipaddress
import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import parse_relations, resolution_type, strip_fence, trim_all
from sparkloom.runtime import materialise


class CompletionClient(Protocol):
    def complete(self, prompt: str) -> str: ...


class EmbeddingClient(Protocol):
    dimension: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class StubCompletion:
    """Answers from a function of the prompt."""

    def __init__(self, answer: Callable[[str], str]):
        self._answer = answer

    def complete(self, prompt: str) -> str:
        return self._answer(prompt)


class HashEmbedding:
    """Deterministic vectors of character bigrams, for tests without a model."""

    def __init__(self, dimension: int = 64):
        self.dimension = dimension

    def embed(self, texts: list[str]) -> list[list[float]]:
        import xxhash

        out = []
        for t in texts:
            v = [0.0] * self.dimension
            for a, b in zip(t, t[1:] or t):
                h = xxhash.xxh3_64_intdigest((a + b).encode("utf-8", "replace"))
                v[h % self.dimension] += 1.0 if h >> 63 else -1.0
            out.append(v)
        return out


def check_loopback(url: str) -> str:
    """The URL, if its host is this machine; other hosts are refused."""
    host = urlparse(url).hostname or ""
    try:
        local = ipaddress.ip_address(host).is_loopback
    except ValueError:
        local = host == "localhost"
    if not local:
        raise ValueError(f"only loopback endpoints are allowed, not {host!r}")
    return url


class HttpCompletion:
    """Chat endpoint of the common form, on this machine, with linear back-off."""

    def __init__(self, url: str, model: str, attempts: int = 3, timeout: float = 60.0, sleep: Callable[[float], None] = time.sleep):
        self.url, self.model, self.attempts, self.timeout, self._sleep = check_loopback(url), model, attempts, timeout, sleep

    def complete(self, prompt: str) -> str:
        body = json.dumps({"model": self.model, "temperature": 0, "response_format": {"type": "json_object"}, "messages": [{"role": "user", "content": prompt}]}).encode()
        for n in range(1, self.attempts + 1):
            try:
                req = urllib.request.Request(self.url, body, {"Content-Type": "application/json"})
                with urllib.request.urlopen(req, timeout=self.timeout) as r:
                    return json.load(r)["choices"][0]["message"]["content"]
            except (OSError, KeyError, ValueError):
                if n == self.attempts:
                    raise
                self._sleep(0.5 * n)
        raise AssertionError


def complete(df: DataFrame, key: str, prompt: str, factory: Callable[[], CompletionClient], label: str = "completions") -> DataFrame:
    """(key, response, error): one call per row, one client per partition; an error stays with its row.

    The result is written to the shared folder, so a client is never asked twice by a re-run of a later stage."""
    slim = df.select(F.col(key).alias("key"), F.col(prompt).alias("prompt"))
    kind = slim.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for pdf in batches:
            got = []
            for p in pdf["prompt"]:
                try:
                    got.append((client.complete(p), None))
                except Exception as e:  # noqa: BLE001
                    got.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame({"key": pdf["key"], "response": [a for a, _ in got], "error": [b for _, b in got]})

    return materialise(slim.mapInPandas(run, f"key {kind}, response string, error string"), label).withColumnRenamed("key", key)


def embed(df: DataFrame, key: str, text: str, factory: Callable[[], EmbeddingClient]) -> DataFrame:
    """(key, embedding): vectors of the texts; a client that returns too few or wrongly sized vectors fails the job."""
    slim = df.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("t"))
    kind = slim.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for pdf in batches:
            v = client.embed(pdf["t"].tolist())
            if len(v) != len(pdf) or any(len(x) != client.dimension for x in v):
                raise ValueError("embedding client returned an incomplete answer")
            yield pd.DataFrame({"key": pdf["key"], "embedding": v})

    return slim.mapInPandas(run, f"key {kind}, embedding array<double>").withColumnRenamed("key", key)


def extract_relations(units: DataFrame, factory: Callable[[], CompletionClient], prompt: str = "{context_text}\n{unit_text}") -> tuple[DataFrame, DataFrame]:
    """(records, errors): raw relations of every unit by a model, unparsable answers and failures apart.

    Records: semantic_unit_id, relations ARRAY<STRUCT<subject, predicate, object>>."""
    text = F.lit(prompt)
    for c in ("context_text", "unit_text"):
        text = F.replace(text, F.lit("{" + c + "}"), F.coalesce(c, F.lit("")))
    got = complete(units.withColumn("_prompt", text), "semantic_unit_id", "_prompt", factory, "extraction")
    parsed = got.withColumn("relations", parse_relations(F.col("response")))
    good = parsed.filter(F.col("error").isNull() & F.col("relations").isNotNull()).select("semantic_unit_id", "relations")
    bad = parsed.filter(F.col("error").isNotNull() | F.col("relations").isNull()).select("semantic_unit_id", F.coalesce("error", F.lit("no relations object")).alias("error"), "response")
    return good, bad


def resolve_contexts(units: DataFrame, factory: Callable[[], CompletionClient]) -> DataFrame:
    """resolved_text and resolution_type of units: leaf items are asked for, all others (those of unknown kind too) are
    copied without a call.

    Repeated units count once. The type follows from the texts; an answer without a text leaves its unit UNRESOLVED."""
    one = units.filter(F.col("semantic_unit_id").isNotNull()).groupBy("semantic_unit_id").agg(F.min(F.struct("unit_kind", "context_text", "unit_text")).alias("u")).select("semantic_unit_id", "u.*")
    leaf = F.col("unit_kind").eqNullSafe("terminal_item")
    copied = one.filter(~leaf).select("semantic_unit_id", F.col("unit_text").alias("resolved_text"), F.lit("COPIED").alias("resolution_type"))
    items = one.filter(leaf)
    asked = complete(items.withColumn("_p", F.concat_ws("\n", "context_text", "unit_text")), "semantic_unit_id", "_p", factory, "contexts")
    text = F.nullif(trim_all(F.from_json(strip_fence(F.col("response")), "STRUCT<resolved_text: STRING>")["resolved_text"]), F.lit(""))
    got = asked.select("semantic_unit_id", text.alias("resolved_text")).join(items.select("semantic_unit_id", "unit_text"), "semantic_unit_id")
    kind = F.when(F.col("resolved_text").isNull(), "UNRESOLVED").otherwise(resolution_type(F.col("unit_text"), F.col("resolved_text")))
    return copied.unionByName(got.select("semantic_unit_id", "resolved_text", kind.alias("resolution_type")))
