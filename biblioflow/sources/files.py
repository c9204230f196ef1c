"""Files as tables: landing zone, PDF documents, CSV tables, JSON snapshots, configuration."""

from __future__ import annotations

import json
import os
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from biblioflow.functions import ids, pages
from biblioflow.session import checkpoint

_MISSING = object()


@dataclass(frozen=True)
class Config:
    """Settings of a JSON file. ``get`` without a default raises for a missing key."""

    values: dict

    @classmethod
    def load(cls, path: str) -> Config:
        if not path.endswith(".json"):
            raise ValueError(f"not a JSON file: {path}")
        return cls(json.loads(Path(path).read_text(encoding="utf-8")))

    def get(self, key: str, default=_MISSING):
        if key in self.values:
            return self.values[key]
        if default is _MISSING:
            raise KeyError(key)
        return default

    def prompt(self, key: str) -> str:
        """A prompt of the YAML file named by ``prompts_file``; '' for any failure."""
        try:
            import yaml

            return yaml.safe_load(Path(self.get("prompts_file")).read_text(encoding="utf-8"))[key]
        except Exception:
            return ""

    def output_path(self, *parts: str) -> str:
        """``output_dir/year/...``, or ``outputs/...`` where neither is set."""
        if "output_dir" in self.values and "year" in self.values:
            return str(Path(self.values["output_dir"], str(self.values["year"]), *parts))
        return str(Path("outputs", *parts))


def fetch(url: str) -> bytes:
    """Body of an address; an error status raises."""
    with urllib.request.urlopen(url, timeout=60) as answer:
        return answer.read()


def download(urls: DataFrame, url: str, present: DataFrame | None = None, get: Callable[[str], bytes] = fetch) -> DataFrame:
    """(url, file_name, content) of every address whose file is not present yet, fetched in executors."""
    wanted = urls.select(F.col(url).alias("url")).distinct().withColumn("file_name", ids.file_name(F.col("url")))
    if present is not None:
        wanted = wanted.join(present.select("file_name"), "file_name", "left_anti")

    def run(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            yield pd.DataFrame({"url": pdf["url"], "file_name": pdf["file_name"], "content": [get(u) for u in pdf["url"]]})

    return wanted.select("url", "file_name").mapInPandas(run, "url string, file_name string, content binary")


def land(urls: DataFrame, url: str, folder: str, get: Callable[[str], bytes] = fetch) -> DataFrame:
    """Raw files of the addresses in a folder that all executors share; (url, file_name, fetched), one row per address.

    A file that is there is not fetched again. A task writes beside the place and
    renames, so a repeated or lost task leaves no half a file. An error status raises.
    """
    wanted = urls.select(F.col(url).alias("url")).distinct().withColumn("file_name", ids.file_name(F.col("url")))
    bare = folder.removeprefix("file://").removeprefix("file:")

    def run(frames: Iterator[pd.DataFrame]):
        os.makedirs(bare, exist_ok=True)
        for pdf in frames:
            done = []
            for u, name in zip(pdf["url"], pdf["file_name"]):
                place = os.path.join(bare, name)
                done.append(not os.path.exists(place))
                if done[-1]:
                    beside = f"{place}.{uuid.uuid4().hex}.part"
                    with open(beside, "wb") as out:
                        out.write(get(u))
                    os.replace(beside, place)
            yield pd.DataFrame({"url": pdf["url"], "file_name": pdf["file_name"], "fetched": done})

    return checkpoint(wanted.select("url", "file_name").mapInPandas(run, "url string, file_name string, fetched boolean"))


def listing(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(file_name) of the files in a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"))


def extract_pages(content: bytes) -> list[str]:
    """Text of every page of a PDF by an optional extractor."""
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("PDF text needs the optional package PyMuPDF") from e
    with fitz.open(stream=content, filetype="pdf") as doc:
        return [p.get_text() for p in doc]


def documents(spark: SparkSession, folder: str, most: int = -1, extract: Callable[[bytes], list[str]] = extract_pages, pattern: str = "*.pdf") -> DataFrame:
    """(id_jems, text_pages, num_pages, file_name) of every file of a folder.

    Blank pages at the end go, then the first ``most`` are kept (0 and below: all).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]):
        for pdf in frames:
            yield pd.DataFrame({"path": pdf["path"], "p": [extract(bytes(c)) for c in pdf["content"]]})

    got = files.mapInPandas(run, "path string, p array<string>").withColumn("text_pages", pages.capped(pages.trim_trailing(F.col("p")), most))
    file = F.element_at(F.split("path", "/"), -1)
    name = F.regexp_replace(file, r"\.[^.]*$", "")
    return got.select(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("id_jems"), "text_pages", F.size("text_pages").alias("num_pages"), file.alias("file_name"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A published CSV table; empty cells are null."""
    return spark.read.schema(schema).option("header", True).option("sep", ";").option("multiLine", True).option("escape", '"').csv(path)


def read_snapshot(spark: SparkSession, path: str, schema: StructType | str, pretty: bool = False) -> DataFrame:
    """A JSON snapshot written by `sinks.write_snapshot`, or (``pretty``) one array in one file."""
    return spark.read.schema(schema).option("multiLine", pretty).json(path)
