"""Readers of registries and sidecars, through Spark's own readers: vocabularies, mappings, CSV rows, file trees, pictures."""

from __future__ import annotations

import io
import json
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ship


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where))


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, cells) of CSV files with rows of any width; a file that is not there has no rows. Quoted line ends are kept."""
    schema = "path string, pos long, cells array<string>"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import csv

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                rows = list(csv.reader(io.StringIO(bytes(content).decode("utf-8-sig", "replace"), newline="")))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.list_(pa.string()))], names=["path", "pos", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, schema)


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(member) of a list with a member a line; comments behind a hash and blank lines are none."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "member string")
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", r"(^|\s)#.*$", "")).alias("member")).where("member <> ''").distinct()


def mapping(spark: SparkSession, path: str, missing_ok: bool = False) -> dict:
    """A mapping from a JSON file, or from lines of "key: value" with lists of "- item" below a key; empty where there is none."""
    if not _exists(spark, path):
        if missing_ok:
            return {}
        raise FileNotFoundError(path)
    text = spark.read.text(path, wholetext=True).first()
    text = text[0] if text else ""
    if text.lstrip().startswith(("{", "[")):
        return json.loads(text)
    out: dict = {}
    key = None
    for line in text.split("\n"):
        bare = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if m := re.fullmatch(r"\s+-\s*(.*)", bare) if key is not None else None:
            out[key] = [*(out[key] or []), _value(m[1])]
        elif m := re.fullmatch(r"([^\s:][^:]*):\s*(.*)", bare):
            key = m[1].strip("\"' ")
            out[key] = _value(m[2])
        elif bare.strip():
            raise ValueError(f"not a mapping: {line!r}")
    return out


def _value(text: str) -> object:
    text = text.strip()
    if text in ("true", "false"):
        return text == "true"
    return None if text in ("", "null", "~") else int(text) if re.fullmatch(r"-?\d+", text) else text.strip("\"'")


def products(spark: SparkSession, path: str) -> DataFrame:
    """(app, abbr, full, match, enforce, class) of a product registry: JSON of application -> entries; a flag that is no boolean raises."""
    rows = []
    for app, entries in sorted(mapping(spark, path, True).items()):
        for e in entries:
            if not isinstance(e.get("enforce", True), bool):
                raise ValueError(f"{app}: enforce must be true or false")
            rows.append((app, str(e["abbr"]), e.get("full"), [str(m) for m in e.get("match") or []], e.get("enforce", True), e.get("class")))
    return spark.createDataFrame(rows, "app string, abbr string, full string, match array<string>, enforce boolean, class string")


def gate_policy(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """What a gate admits: prefixes of systems, denied statuses, omitted types."""
    told = mapping(spark, path)
    return {k: [str(x) for x in told.get(k) or []] for k in ("prefixes", "denied", "omitted")}


def file_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path below root, length, digest) of all files of a tree; contents are read for the digest only where it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), "^" + re.escape(re.sub("^[a-z]+:/*", "/", root).rstrip("/")) + "/", "")
    return files.select(below.alias("path"), "length", F.sha2("content", 256).alias("digest"))


_DRAW = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PLACE = "{http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing}"


def pictures(content: bytes) -> list[tuple[str, str, bytes]]:
    """(name, alternative text, bytes) of the pictures of a word-processor file, in document order; of no such file none."""
    try:
        pack = zipfile.ZipFile(io.BytesIO(content))
        body, links = ET.fromstring(pack.read("word/document.xml")), ET.fromstring(pack.read("word/_rels/document.xml.rels"))
    except (zipfile.BadZipFile, KeyError, ET.ParseError):
        return []
    target = {r.get("Id"): posixpath.normpath(posixpath.join("word", r.get("Target", ""))) for r in links}
    inside = set(pack.namelist())
    found = []
    alt = ""
    for node in body.iter():
        if node.tag == f"{_PLACE}docPr":
            alt = node.get("descr") or node.get("title") or ""
        elif node.tag == f"{_DRAW}blip" and target.get(node.get(f"{_LINK}embed")) in inside:
            name = target[node.get(f"{_LINK}embed")]
            found.append((posixpath.basename(name), alt, pack.read(name)))
    return found


def docx_pictures(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """(key, pos, name, alt, digest) of the pictures of each file."""
    ship(files.sparkSession)
    kind = files.schema[key].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for i, one in enumerate(batch.column(content).to_pylist()):
                rows = pictures(bytes(one or b""))
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array([i] * len(rows), pa.int64())), pa.array(range(len(rows)), pa.int64()), *[pa.array([r[j] for r in rows], pa.string()) for j in (0, 1)], pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())], names=[key, "pos", "name", "alt", "digest"])

    return files.select(key, content).mapInArrow(read, f"{key} {kind}, pos long, name string, alt string, digest string")


def parse_frontmatter(text: str) -> tuple[dict, str]:
    """The keys of a block in front of a body, and the body; a text without a sound block is all body."""
    m = re.match(r"---\n(.*?)\n---\n?", text, re.S)
    if not m:
        return {}, text
    meta: dict = {}
    for line in m[1].split("\n"):
        item = re.fullmatch(r"([\w-]+):\s*(.*)", line)
        if not item:
            return {}, text
        try:
            meta[item[1]] = json.loads(item[2]) if item[2][:1] in '["{' else _value(item[2])
        except json.JSONDecodeError:
            return {}, text
    return meta, text[m.end() :]


#: Keys that come first, in this order; the others follow by name.
FIRST_KEYS = ["title", "doc_id", "app_code", "doc_type", "version", "published"]


def emit_frontmatter(meta: dict, body: str) -> str:
    """The inverse of parse_frontmatter()."""
    keys = [k for k in FIRST_KEYS if k in meta] + sorted(k for k in meta if k not in FIRST_KEYS)
    if not keys:
        return body
    plain = lambda v: isinstance(v, str) and _value(v) == v and v == v.strip() and v[:1] not in '["{' and "\n" not in v and "#" not in v
    told = lambda v: v if plain(v) else json.dumps(v, ensure_ascii=False)
    return "---\n" + "\n".join(f"{k}: {told(meta[k])}" for k in keys) + "\n---\n" + body
