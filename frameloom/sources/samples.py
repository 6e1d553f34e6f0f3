"""Sources of samples: generated, a devkit's JSON tables, artifacts, images."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.functions import images
from frameloom.functions.text import infer_time_of_day, infer_weather
from frameloom.schema import SAMPLES

#: Cycled by scene number. Fixed values.
LOCATIONS = ("boston-seaport", "singapore-onenorth", "singapore-queenstown", "singapore-hollandvillage")
WEATHER = ("clear", "clear", "clear", "rain", "rain", "fog")
TIMES = ("day", "day", "day", "night", "night", "dusk")
TEMPLATES = ("urban_intersection", "highway_merge", "tunnel", "construction_zone", "residential", "parking_lot")
BASE_TIMESTAMP = 1_700_000_000_000_000


def _pick(values: tuple[str, ...], at) -> F.Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (at % len(values) + 1).cast("int"))


def _uniform(seed: int, name: str) -> F.Column:
    """A number in [0, 1) of the row's idx, the same in any partitioning."""
    text = F.concat(F.lit(f"{seed}:{name}:"), F.col("idx").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def synthetic_samples(spark: SparkSession, n: int = 400, n_scenes: int = 24, duplicate_rate: float = 0.12, seed: int = 7) -> DataFrame:
    """Samples dealt to scenes in turn; a share of those after the sixth are near-copies of an earlier frame of their scene.

    Every random choice is a hash of seed and number. A copy is named after the last six characters of the frame it copies.
    """
    rows = spark.range(n).select(F.col("id").alias("idx")).withColumn("scene", F.col("idx") % n_scenes).withColumn("before", F.floor(F.col("idx") / n_scenes))
    copy = (_uniform(seed, "dup") < duplicate_rate) & (F.col("idx") > 5) & (F.col("before") > 0)
    # the earlier frames of a scene are idx - n_scenes, idx - 2 n_scenes, ...: one is chosen by number, without a join
    back = (F.floor(_uniform(seed, "sibling") * F.col("before")) + 1) * n_scenes
    own, other = (F.concat(F.lit("sample_"), F.lpad(x.cast("string"), 5, "0")) for x in (F.col("idx"), F.col("idx") - back))
    rows = rows.withColumn("sample_token", F.when(copy, F.concat(own, F.lit("_dup_"), F.right(other, F.lit(6)))).otherwise(own))
    rows = rows.withColumn("scene_name", F.concat(F.lit("scene-"), F.lpad(F.col("scene").cast("string"), 4, "0"), F.lit("-"), _pick(TEMPLATES, F.col("scene"))))
    values = {
        "scene_token": F.substring(F.md5("scene_name"), 1, 16), "timestamp": F.lit(BASE_TIMESTAMP) + F.col("idx") * 500_000, "camera": F.lit("CAM_FRONT"),
        "cam_path": F.concat(F.lit("synthetic://"), "sample_token", F.lit("/CAM_FRONT.jpg")), "lidar_path": F.concat(F.lit("synthetic://"), "sample_token", F.lit("/LIDAR_TOP.bin")),
        "location": _pick(LOCATIONS, F.col("scene")), "weather": _pick(WEATHER, F.col("scene")), "time_of_day": _pick(TIMES, F.col("scene")),
        "ego_speed_mps": _uniform(seed, "speed") * 22.0, "num_lidar_pts": F.lit(20_000) + F.floor(_uniform(seed, "points") * 100_001),
    }
    return rows.select(*(values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SAMPLES))


#: Base colour of each template in generated pictures.
COLOURS = {"urban_intersection": (90, 110, 100), "highway_merge": (70, 95, 120), "tunnel": (35, 30, 25), "construction_zone": (200, 120, 30), "residential": (110, 140, 70), "parking_lot": (140, 140, 150)}


def frame_picture(token: str, scene: str | None, weather: str | None, time: str | None, side: int) -> np.ndarray:
    """A small deterministic picture of a generated frame, side x side x 3 values from 0 to 1.

    Sky over road in the template's colour, darker at night and dusk, greyer in rain and fog, with shapes and noise seeded by
    the frame; a copy has its original's picture, a little blurred.
    """
    original, _, copied = token.partition("_dup_")
    source, template = f"sample_{copied[-5:]}" if copied else original, (scene or "").split("-")[-1]
    rng = np.random.default_rng(int(hashlib.md5(source.encode()).hexdigest()[:8], 16))
    height = np.linspace(1.2, 0.6, side)[:, None, None]
    picture = np.ones((side, side, 3)) * np.array(COLOURS.get(template, (100, 100, 100))) / 255 * height
    unit = max(1, side // 8)
    for _ in range(3):
        y, x = unit * rng.integers(side // 2 // unit, side // unit), unit * rng.integers(0, side // unit)
        picture[y : y + unit, max(0, x - unit) : x + unit] = rng.random(3)
    picture = picture * {"night": 0.3, "dusk": 0.65}.get(time, 1.0)
    if weather in ("rain", "fog"):
        picture = picture * 0.6 + (0.2 if weather == "rain" else 0.35)
    picture = np.clip(picture + rng.normal(0, 0.03, picture.shape), 0, 1)
    return 0.94 * picture + 0.06 * np.roll(picture, unit, 1) if copied else picture


def synthetic_pictures(samples: DataFrame, side: int = 224) -> DataFrame:
    """sample_token, content: each generated frame as a PNG of side x side pixels."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                found = [images.png_bytes(np.rint(255 * frame_picture(*row, side)).astype(np.uint8)) for row in zip(*(part.column(i).to_pylist() for i in range(4)))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["sample_token", "content"])

    return samples.select("sample_token", "scene_name", "weather", "time_of_day").mapInArrow(run, "sample_token string, content binary")


def synthetic_features(samples: DataFrame, side: int = 8) -> DataFrame:
    """sample_token, features: the picture of each generated frame, as side x side x 3 values from 0 to 1."""
    def run(batches):
        for b in batches:
            out = []
            for token, scene, weather, time in zip(*(b.column(i).to_pylist() for i in range(4))):
                out.append(frame_picture(token, scene, weather, time, side).astype(np.float32).reshape(-1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float32()))], ["sample_token", "features"])

    return samples.select("sample_token", "scene_name", "weather", "time_of_day").mapInArrow(run, "sample_token string, features array<float>")


def keyframe_join(sample: DataFrame, sample_data: DataFrame, scene: DataFrame, log: DataFrame) -> DataFrame:
    """Samples with their front camera and lidar files, scene and log. Channels are told by the file's folder.

    All joins are equi-joins by token, which Spark sends around or shuffles by size; samples without either file are left out.
    """
    frames = sample_data.where("is_key_frame")
    cam = frames.where("filename like '%/CAM_FRONT/%'").select(F.col("sample_token").alias("token"), F.col("filename").alias("cam_path"))
    lidar = frames.where("filename like '%/LIDAR_TOP/%'").select(F.col("sample_token").alias("token"), F.col("filename").alias("lidar_path"))
    scenes = scene.select(F.col("token").alias("scene_token"), F.col("name").alias("scene_name"), "description", "log_token")
    logs = log.select(F.col("token").alias("log_token"), "location")
    rows = sample.join(cam, "token").join(lidar, "token").join(scenes, "scene_token").join(logs, "log_token")
    values = {"sample_token": F.col("token"), "camera": F.lit("CAM_FRONT"), "weather": infer_weather(F.col("description")), "time_of_day": infer_time_of_day(F.col("description")), "ego_speed_mps": F.lit(0.0), "num_lidar_pts": F.lit(0)}
    return rows.select(*(values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SAMPLES))


def nuscenes_samples(spark: SparkSession, root: str, version: str = "v1.0-mini", max_samples: int | None = None) -> DataFrame:
    """Samples of a devkit folder whose camera file exists; the limit counts the rows that are left, in order of time."""
    table = {t: spark.read.option("multiLine", True).json(f"{root}/{version}/{t}.json") for t in ("sample", "sample_data", "scene", "log")}
    rows = keyframe_join(table["sample"], table["sample_data"], table["scene"], table["log"])
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/samples/CAM_FRONT").select(F.regexp_extract("path", r"(samples/CAM_FRONT/.*)$", 1).alias("cam_path"))
    rows = rows.join(there, "cam_path", "left_semi").select(*SAMPLES.fieldNames())
    return rows if max_samples is None else rows.orderBy("timestamp", "sample_token").limit(max_samples)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """path, content of image files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")


def decode_images(files: DataFrame, key: str = "path", column: str = "content", size: int | None = 224, thumb: int = 192) -> DataFrame:
    """key, height, width (of the file), pixels (RGB bytes at size x size, or at the file's size for None), features (8 x 8 x 3
    from 0 to 1), thumb (a PNG within ``thumb`` x ``thumb``) and thumb_base64 of PNG and PPM files.

    Null, broken and other files (there is no library for JPEG here) have nulls.
    """
    names = [key, "height", "width", "pixels", "features", "thumb", "thumb_base64"]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float32()), pa.binary(), pa.string()]

    def one(data: bytes | None) -> tuple:
        rgb = images.read_picture(data)
        if rgb is None:
            return (None,) * 6
        fit, small = rgb if size is None else images.resize(rgb, size, size), images.thumbnail(rgb, thumb)
        return *rgb.shape[:2], fit.tobytes(), images.features(rgb), images.png_bytes(small), images.as_text(small)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                found = list(zip(*map(one, part.column(1).to_pylist())))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(found, types))], names)

    return files.select(key, column).mapInArrow(run, f"{key} {files.schema[key].dataType.simpleString()}, height int, width int, pixels binary, features array<float>, thumb binary, thumb_base64 string")


def first_rows(samples: DataFrame) -> DataFrame:
    """One row a token: of repeated ones the latest ingested, of those the smallest by its other columns. Null tokens are left out."""
    others = [F.col(c) for c in SAMPLES.fieldNames()[1:]]
    late = [F.desc_nulls_last("ingested_at")] if "ingested_at" in samples.columns else []
    w = Window.partitionBy("sample_token").orderBy(*late, *others)
    return samples.where("sample_token is not null").withColumn("at", F.row_number().over(w)).where("at = 1").drop("at")


def read_artifact(spark: SparkSession, path: str, schema: str, required: bool = True) -> DataFrame:
    """A JSON artifact, one document however it is indented, or lines of them; a missing one raises, or with required=False is an empty
    table of its schema. A document that is a list gives a row an item."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    status = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath)
    # a folder holds lines, as Spark writes them; a file is one document, unless every line of it is one
    lines = spark.read.schema(schema).option("mode", "FAILFAST")
    if status.isDirectory():
        return lines.json(path)
    start = spark.read.text(path).where("trim(value) <> ''").limit(1).collect()
    whole = not start or not start[0].value.strip().startswith("{") or not start[0].value.strip().endswith("}")
    return lines.option("multiLine", whole).json(path)
