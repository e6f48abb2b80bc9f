"""Entities found in text, and the weighted edges between documents and entities."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ship, staged


def mentions(docs: DataFrame, rules: list[tuple[str, str]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each match of each (type, pattern with one group): key, pos (line number), type, canonical.

    Each line is a section of its document, its number the position.
    """
    each = docs.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("section", "line"))
    found = F.concat(*[F.transform(F.regexp_extract_all("line", F.lit(p), F.lit(1)), _typed(kind)) for kind, p in rules])
    return each.select(key, "section", F.explode(found).alias("m")).select(key, "section", "m.type", "m.canonical").withColumn("entity_id", F.concat_ws(":", "type", "canonical"))


def _typed(kind: str):
    return lambda m: F.struct(F.lit(kind).alias("type"), F.upper(m).alias("canonical"))


def edges(found: DataFrame, xref_types: list[str], key: str = "doc_id") -> DataFrame:
    """(src, rel, dst, weight): mentions (occurrences), cooccurs (sections that hold both entities, smaller id
    first) and xref (significant entities that two documents share)."""
    mentioned = found.groupBy(F.col(key).cast("string").alias("src"), F.col("entity_id").alias("dst")).agg(F.count("*").alias("weight")).select("src", F.lit("mentions").alias("rel"), "dst", "weight")
    in_section = found.select(key, "section", "entity_id").distinct()
    a, b = in_section.withColumnRenamed("entity_id", "src"), in_section.withColumnRenamed("entity_id", "dst")
    together = a.join(b, [key, "section"]).where("src < dst").groupBy("src", "dst").agg(F.count("*").alias("weight")).select("src", F.lit("cooccurs").alias("rel"), "dst", "weight")
    significant = found.where(F.col("type").isin(xref_types)).select(F.col(key).alias("doc"), "entity_id").distinct()
    shared = shared_counts(significant).select(F.col("x").cast("string").alias("src"), F.lit("xref").alias("rel"), F.col("y").cast("string").alias("dst"), "weight")
    return mentioned.unionByName(together).unionByName(shared)


#: Documents of a block of an entity's documents; two blocks meet in one group.
BLOCK = 1024


def _tile(table: pa.Table) -> pa.Table:
    """Of two blocks of profiles (or one with itself): how many entities each two share, where they share any."""
    number, p, mine = (table.column(c).to_numpy() for c in ("number", "p", "mine"))
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    left, right = np.unique(p[mine == i]), np.unique(p[mine == j])
    shared = np.zeros((len(left), len(right)), np.int64)
    order = np.argsort(number, kind="stable")
    number, p, mine = number[order], p[order], mine[order]
    first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    for a, b in zip(first, [*first[1:], len(number)], strict=True):
        x, y = (np.searchsorted(side, p[a:b][mine[a:b] == k]) for side, k in ((left, i), (right, j)))
        shared[np.ix_(x, y)] += 1
    x, y = np.nonzero(np.triu(shared, 1) if i == j else shared)
    lower, upper = np.minimum(left[x], right[y]), np.maximum(left[x], right[y])
    return pa.table({"pa": pa.array(lower), "pb": pa.array(upper), "weight": pa.array(shared[x, y])})


def shared_counts(rows: DataFrame, block: int | None = None) -> DataFrame:
    """rows(doc, entity_id), distinct -> (x, y, weight): how many entities two documents share, x < y.

    Documents with the same entities are one profile, and only profiles are paired. An entity of at most ``block`` profiles is joined with
    itself. Of commoner ones the profiles are cut into blocks, and two blocks are a tile of a product: a task adds up, for all common entities
    together, how many each two profiles of its tile share, so that what is sent grows with the entities of profiles times the
    blocks and not with the pairs of an entity. The rows returned, one for each pair of documents, are the result itself."""
    block = block or BLOCK
    ship(rows.sparkSession)
    profile = staged(rows.groupBy("doc").agg(F.sort_array(F.collect_set("entity_id")).alias("entities")), "profiles")
    named = staged(profile.groupBy("entities").agg(F.count("*").alias("docs")).withColumn("p", F.monotonically_increasing_id()), "profile-classes")
    each = named.select("p", F.explode("entities").alias("e"))
    sized = each.groupBy("e").agg(F.count("*").alias("n")).where("n > 1")
    sized = staged(sized.withColumn("number", F.monotonically_increasing_id()), "entity-sizes")
    placed = staged(each.join(sized, "e").select("number", "p", (F.col("n") > block).alias("common")), "entity-profiles")
    rare = placed.where("NOT common").select("number", "p")
    a, b = rare.withColumnRenamed("p", "pa"), rare.withColumnRenamed("p", "pb")
    counts = a.join(b, "number").where("pa < pb").groupBy("pa", "pb").agg(F.count("*").alias("weight"))
    common = placed.where("common").select("number", "p")
    held = common.select("p").distinct().count()
    if held:
        blocks = -(-held // block)
        mine = common.withColumn("mine", F.pmod(F.xxhash64("p"), F.lit(blocks)))
        dealt = mine.select("number", "p", "mine", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
        tiles = dealt.select(F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "number", "p")
        counts = counts.unionByName(tiles.groupBy("i", "j").applyInArrow(_tile, "pa long, pb long, weight long")).groupBy("pa", "pb").agg(F.sum("weight").alias("weight"))
    # Documents of one profile share all its entities with each other.
    own = named.where("docs > 1").select(F.col("p").alias("pa"), F.col("p").alias("pb"), F.size("entities").cast("long").alias("weight"))
    members = staged(profile.join(named.select("entities", "p"), "entities").select("doc", "p"), "profile-members")
    both = counts.unionByName(own)
    x, y = members.select(F.col("doc").alias("dx"), F.col("p").alias("pa")), members.select(F.col("doc").alias("dy"), F.col("p").alias("pb"))
    pairs = both.join(x, "pa").join(y, "pb").where("pa <> pb OR dx < dy")
    return pairs.select(F.least("dx", "dy").alias("x"), F.greatest("dx", "dy").alias("y"), "weight")


def entity_counts(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.groupBy("entity_id", "type").agg(F.count("*").alias("mentions"), F.countDistinct(key).alias("documents"))


def top_per_type(counts: DataFrame, n: int = 25, low_signal: dict[str, int] | None = None) -> DataFrame:
    """The most mentioned of each type (by id among equals), fewer for types of low signal."""
    rank = F.row_number().over(Window.partitionBy("type").orderBy(F.desc("mentions"), "entity_id"))
    bound = F.lit(n)
    for kind, m in (low_signal or {}).items():
        bound = F.when(F.col("type") == kind, m).otherwise(bound)
    return counts.withColumn("rank", rank.cast("long")).where(F.col("rank") <= bound)


def tag_texts(texts: DataFrame, surfaces: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct (key, node) where a surface stands in the text as whole words.

    Word sequences are joined to the surfaces, not compared one by one, for each length in words that a surface has;
    the lengths, a few numbers, are counted first.
    """
    words_of = lambda c: F.regexp_extract_all(F.upper(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    named = surfaces.select(words_of(F.col("surface")).alias("w"), "node").where(F.size("w") > 0)
    lengths = sorted(r[0] for r in named.select(F.size("w")).distinct().collect())

    def of_length(w, n):
        each = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, each).otherwise(F.array().cast("array<string>"))

    def grams_of(w):
        some = [of_length(w, n) for n in lengths]
        return F.flatten(F.array(*some)) if some else F.array().cast("array<string>")

    grams = F.transform(F.array(words_of(F.col(text))), grams_of)[0]
    each = texts.select(key, F.explode(F.array_distinct(grams)).alias("surface"))
    return each.join(named.select(F.array_join("w", " ").alias("surface"), "node"), "surface").select(key, "node").distinct()
