"""What a corpus ships: cards, glossaries, term lists, bundles with manifests, and archives that are the same for the same content."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import tarfile
from collections.abc import Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bundle_manifest(parts: Mapping[str, bytes], **facts: object) -> dict:
    """Parts with their digests, and one digest over all of them."""
    told = {name: hashlib.sha256(data).hexdigest() for name, data in sorted(parts.items())}
    return {**facts, "parts": told, "digest": hashlib.sha256("\n".join(f"{k}:{v}" for k, v in told.items()).encode()).hexdigest()}


def archive(parts: Mapping[str, bytes]) -> bytes:
    """A tar.gz of parts that has the same bytes whenever and wherever it is made."""
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", mtime=0, filename="") as packed, tarfile.open(fileobj=packed, mode="w", format=tarfile.PAX_FORMAT) as tar:
        for name, data in sorted(parts.items()):
            info = tarfile.TarInfo(name)
            info.size, info.mtime, info.mode = len(data), 0, 0o644
            tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


def corpus_card(documents: DataFrame, app: str, title: str, shown: int = 5) -> DataFrame:
    """(app, n, card): a section of the card for each application, with the first titles by name."""
    place = F.row_number().over(Window.partitionBy(app).orderBy(title))
    ranked = documents.select(app, title).withColumn("_place", place)
    line = F.concat(F.lit("- "), F.col(title))
    one = ranked.groupBy(app).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("_place") <= shown, line))).alias("_lines"))
    head = F.concat(F.lit("## "), F.col(app), F.lit(" ("), F.col("n").cast("string"), F.lit(")\n"))
    more = F.when(F.col("n") > shown, F.concat(F.lit("\n- and "), (F.col("n") - shown).cast("string"), F.lit(" more"))).otherwise("")
    return one.select(app, "n", F.concat(head, F.array_join("_lines", "\n"), more).alias("card"))


def vocabulary_rows(**kinds: DataFrame) -> DataFrame:
    """(kind, code, label) of several vocabularies with code and label, each row once."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("kind"), "code", "label") for k, df in sorted(kinds.items())]).distinct()


def term_artifacts(terms: DataFrame, corrections: Mapping[str, str]) -> dict[str, DataFrame]:
    """Lists for a prose linter: accepted words, spellings to put in the place of others, and typos."""
    accept = terms.select(F.explode(F.split("surface", " ")).alias("word")).where("word <> ''").distinct()
    single = terms.where(~F.contains("surface", F.lit(" ")) & F.col("enforce") & ~F.col("collides"))
    swap = single.select(F.lower("surface").alias("wrong"), F.col("surface").alias("right")).where("wrong <> right")
    spark = terms.sparkSession
    typos = spark.createDataFrame(sorted(corrections.items()), "wrong string, right string")
    return {"accept": accept, "swap": swap, "typos": typos}


def json_lines(rows: DataFrame) -> DataFrame:
    """(line) of rows as JSON, flags as numbers, keys in the order of the columns."""
    flags = [F.col(c).cast("int").alias(c) if t == "boolean" else F.col(c) for c, t in rows.dtypes]
    return rows.select(F.to_json(F.struct(*flags), {"ignoreNullFields": "false"}).alias("line"))


def manifest_json(facts: Mapping[str, object]) -> str:
    return json.dumps(facts, sort_keys=True, indent=1, ensure_ascii=False)


def volumes(parts: DataFrame, aim: int) -> DataFrame:
    """parts(bundle, name, content; distinct names of a bundle) -> (bundle, volume, parts, bytes, digest, archive): bundles as archives of about aim bytes.

    A bundle has as many volumes as its bytes ask for, and a part's volume follows from its name, so that the same parts make the same
    bytes however they are partitioned. A task holds one volume. Null contents are empty; rows without bundle or name are left out."""
    rows = parts.where("bundle IS NOT NULL AND name IS NOT NULL").select("bundle", "name", F.coalesce(F.col("content").cast("binary"), F.lit(b"")).alias("content"))
    sized = rows.groupBy("bundle").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.length("content")) / F.lit(aim))).alias("volumes"))
    dealt = rows.join(sized, "bundle").withColumn("volume", F.conv(F.substring(F.md5(F.col("name").cast("binary")), 1, 8), 16, 10).cast("long") % F.col("volumes"))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        held = {r.name: bytes(r.content) for r in part[["name", "content"]].itertuples(index=False, name="R")}
        told = bundle_manifest(held)
        return pd.DataFrame([(key[0], int(key[1]), len(held), sum(map(len, held.values())), told["digest"], archive(held))])

    kind = parts.schema["bundle"].dataType.simpleString()
    return dealt.groupBy("bundle", "volume").applyInPandas(pack, f"bundle {kind}, volume long, parts long, bytes long, digest string, archive binary")


def manifest(parts: DataFrame, packed: DataFrame) -> DataFrame:
    """(bundle, volumes, parts, bytes, digest) of bundles from their volumes: the digest is over those of the volumes in order."""
    told = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("volume", "digest"))), lambda v: v["digest"]), "\n"), 256)
    rows = packed.groupBy("bundle").agg(F.count("*").alias("volumes"), F.sum("parts").alias("parts"), F.sum("bytes").alias("bytes"), told.alias("digest"))
    return parts.select("bundle").where("bundle IS NOT NULL").distinct().join(rows, "bundle", "left")


def opened(packed: DataFrame) -> DataFrame:
    """The members of volumes' archives: packed's columns without the archive, name and content."""
    kept = [c for c in packed.columns if c != "archive"]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                with tarfile.open(fileobj=io.BytesIO(bytes(row["archive"])), mode="r:gz") as tar:
                    members = [(m.name, tar.extractfile(m).read()) for m in tar.getmembers()]
                yield pd.DataFrame([(*[row[c] for c in kept], n, data) for n, data in members], columns=[*kept, "name", "content"])

    schema = ", ".join(f"{c} {packed.schema[c].dataType.simpleString()}" for c in kept)
    return packed.mapInPandas(read, f"{schema}, name string, content binary")
