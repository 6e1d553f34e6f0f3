"""Splits that keep related records together (problem 3).

Scene names are written in many ways. Each distinct name is read once: its number is the one that goes with the word scene;
its template is the run of its words that is, or is one edit away from, a template of the regular form
``scene-<number>-<template>``. A template that few scenes carry and that is one edit from one of many more scenes is a
misspelling of it. One graph holds what links records: names to the spelling that they contain, spellings to the scene (number
and template) that they mean, and tokens to the names they are seen under. Its components, by alternating stars, are the units that a
split never cuts; those of its links between names, spellings and scenes tell which names are of one scene.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.llm.components import star_components
from frameloom.session import stage

WORD = re.compile(r"[^\W\d_]+")
NUMBER = (re.compile(r"scene[\W_]*(\d+)"), re.compile(r"(\d+)[\W_]*scene"))
BESIDE = re.compile(r"([^\W\d_]+)[\W_]*(\d+)")
ANY = re.compile(r"(\d+)")
REGULAR = re.compile(r"scene-\d+-([^\W\d_]+(?:_[^\W\d_]+)*)")


def _cuts(word: str) -> set[str]:
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def _number(text: str) -> tuple[str, int, int] | None:
    """The number that goes with the word scene, else with a word one edit away from it, else the first; with its place."""
    for pattern in NUMBER:
        if m := pattern.search(text):
            return m[1], m.start(), m.end()
    for m in BESIDE.finditer(text):
        if _cuts(m[1]) & _cuts("scene"):
            return m[2], m.start(), m.end()
    m = ANY.search(text)
    return (m[1], m.start(), m.end()) if m else None


def read_name(name: str) -> tuple[str | None, str | None, list[str]]:
    """Number without leading zeros, template if the name has the regular form, and each run of its words in one piece."""
    text = unicodedata.normalize("NFKC", name).lower().strip()
    found = _number(text)
    if not found:
        return None, None, []
    number = found[0].lstrip("0") or "0"
    regular = REGULAR.fullmatch(text)
    runs = []
    for side in (text[: found[1]], text[found[2] :]):
        words = WORD.findall(side)
        runs += ["".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, min(len(words), i + 5) + 1)]
    return number, "".join(WORD.findall(regular[1])) if regular else None, list(dict.fromkeys(runs))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [read_name(x) for x in b.column(0).to_pylist()]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.list_(pa.string())))]
        yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["scene_name", "number", "template", "runs"])


def _near(text: Column) -> Column:
    """The text and all that a single deletion makes of it: texts one edit (or one swap) apart have one of these in common."""
    cut = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))
    return F.explode(F.array_distinct(F.concat(F.array(text), cut)))


def scene_keys(samples: DataFrame) -> DataFrame:
    """scene_name, spelling, key: each distinct non-empty name, its number with the run of words that tells its scene, and that scene,
    as number|template."""
    filled = F.col("scene_name").isNotNull() & (F.col("scene_name") != "")
    names = samples.select(F.col("scene_name").cast("string").alias("scene_name")).where(filled).distinct()
    names = stage(names.mapInArrow(_read, "scene_name string, number string, template string, runs array<string>"), "names")
    known = names.where("template is not null").groupBy("template").agg(F.countDistinct("number").alias("scenes"))
    known = stage(known, "templates")
    forms = stage(known.select("template", "scenes", _near(F.col("template")).alias("form")), "forms")
    other = forms.select(F.col("template").alias("right"), F.col("scenes").alias("more"), "form")
    better = forms.join(other, "form").where((F.col("template") != F.col("right")) & (F.col("more") >= 2 * F.col("scenes")))
    better = better.groupBy("template").agg(F.max(F.struct("more", "right")).alias("best")).select("template", F.col("best.right").alias("right"))
    runs = names.select("scene_name", "number", F.explode("runs").alias("run"))
    matched = runs.select("run").distinct().select("run", _near(F.col("run")).alias("form")).join(forms, "form")
    rank = F.struct((F.col("run") == F.col("template")).alias("same"), F.col("scenes"), F.col("template"))
    matched = matched.groupBy("run").agg(F.max(rank).alias("m")).select("run", F.col("m.same").alias("same"), F.col("m.scenes").alias("scenes"), F.col("m.template").alias("template"))
    matched = matched.join(better, "template", "left").withColumn("template", F.coalesce("right", "template"))
    # the longest run that is a template or nearly one: a word that templates share never stands for one of them
    chosen = runs.join(matched, "run").groupBy("scene_name").agg(F.max(F.struct(F.length("run").alias("n"), "same", "scenes", "template", "run")).alias("m"))
    out = names.join(chosen.select("scene_name", F.col("m.template").alias("fit"), F.col("m.run").alias("as_written")), "scene_name", "left")
    bare = F.array_join(F.array_sort(F.col("runs")), " ")
    scene = lambda text: F.when(F.col("number").isNull(), F.concat(F.lit("name|"), F.col("scene_name"))).otherwise(F.concat_ws("|", "number", text))
    return out.select("scene_name", scene(F.coalesce("as_written", bare)).alias("spelling"), scene(F.coalesce("fit", bare)).alias("key"))


def scene_links(samples: DataFrame) -> DataFrame:
    """src, dst: names (n:) with their spelling (w:), and spellings with their scene (e:)."""
    keys = stage(scene_keys(samples), "keys")
    node = lambda kind, c: F.concat(F.lit(kind), F.col(c))
    return keys.select(node("n:", "scene_name").alias("src"), node("w:", "spelling").alias("dst")).unionByName(keys.select(node("w:", "spelling").alias("src"), node("e:", "key").alias("dst")).distinct())


def same_scene_pairs(samples: DataFrame) -> DataFrame:
    """scene_name_a, scene_name_b: each pair of different non-empty names, as stored, of the same scene, the smaller first.

    The pairs come from the components of the links of names, spellings and scenes. A token seen under the names of two scenes
    doesn't make them one. Null and empty names take no part; a name without any number is a scene of its own; no rows give no rows.
    """
    nodes = star_components(scene_links(samples)).where(F.col("node").startswith("n:")).select("label", F.expr("substring(node, 3)").alias("name"))
    nodes = stage(nodes, "nodes")
    pairs = nodes.alias("x").join(nodes.alias("y"), (F.col("x.label") == F.col("y.label")) & (F.col("x.name") < F.col("y.name")))
    return pairs.select(F.col("x.name").alias("scene_name_a"), F.col("y.name").alias("scene_name_b"))


def assign_splits(samples: DataFrame, shares: DataFrame, buckets: int = 4096, fixed: bool = False, seed: int = 5) -> DataFrame:
    """sample_token, split_name, component: each token once, in the split of its component.

    Components are ordered by a hash of their identifier; the ranges of the splits are cut in that order where the records
    before them reach the shares, so a very large component shifts the cuts instead of the proportions. With ``fixed`` they are cut by
    the hash alone: then more records never move a component, but proportions are met only on average. Shares that are null
    or not positive count as none, and the rest are scaled to 1. A token seen under several names joins their scenes. A
    record without a name is a component of its own. A null token has no record; no usable share gives null splits.
    """
    name = F.when(F.col("scene_name") != "", F.concat(F.lit("n:"), F.col("scene_name").cast("string"))).alias("name")
    rows = stage(samples.select(F.col("sample_token").cast("string").alias("token"), name).where("token is not null").distinct(), "records")
    single = rows.groupBy("token").agg(F.min("name").alias("name"), F.max("name").alias("last"))
    several = single.where("name <> last").select("token")
    seen = rows.where("name is not null").join(several, "token", "left_semi").select(F.concat(F.lit("t:"), "token").alias("src"), F.col("name").alias("dst"))
    roots = star_components(scene_links(samples).unionByName(seen)).select(F.col("node").alias("name"), "label")
    placed = single.join(roots, "name", "left").select("token", F.coalesce("label", F.concat(F.lit("t:"), "token")).alias("component"))
    placed = stage(placed.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "component"), F.lit(buckets)).cast("int")), "placed")
    mass = placed.groupBy("bucket").count()  # at most ``buckets`` rows
    if fixed:
        mass = mass.select("bucket", ((F.col("bucket") + 0.5) / buckets).alias("at"))
    else:
        total = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = F.sum("count").over(total) - F.col("count") / 2
        mass = mass.select("bucket", (before / F.sum("count").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("at"))
    # the table of splits is a parameter list: its size is checked before it becomes literals
    listed = shares.where("share > 0 and split_name is not null").groupBy("split_name").agg(F.max("share").alias("share")).orderBy(F.desc("share"), "split_name").take(1001)
    if len(listed) > 1000:
        raise ValueError("more than 1,000 splits")
    name, so_far, whole = F.lit(None).cast("string"), 1.0, sum(r.share for r in listed)
    for r in reversed(listed):
        so_far -= r.share / whole
        name = F.when(F.col("at") < so_far + r.share / whole, F.lit(r.split_name)).otherwise(name) if name is not None and r is not listed[-1] else F.lit(r.split_name)
    return placed.join(mass.select("bucket", name.alias("split_name")), "bucket").select(F.col("token").alias("sample_token"), "split_name", "component")
