"""Command line of a curation run: ``python -m frameloom --out FOLDER ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from frameloom.operators.encode import get_encoder
from frameloom.operators.report import git_sha
from frameloom.plans.pipeline import CurationConfig, CurationPipeline
from frameloom.session import get_spark
from frameloom.sources import samples as S


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="frameloom", description="Curates embedded frames.")
    p.add_argument("--source", choices=["synthetic", "nuscenes", "table"], default="synthetic")
    p.add_argument("--n", type=int, default=400, help="generated samples")
    p.add_argument("--dataroot", default="./data/nuscenes", help="devkit folder, or a folder of samples.parquet and encoded_batch.parquet")
    p.add_argument("--encoder", choices=["auto", "torch", "projection"], default="auto")
    p.add_argument("--vector-backend", choices=["auto", "exact", "index"], default="auto")
    p.add_argument("--projection", choices=["axes", "neighbours"], default="axes", help="plane of the points: principal axes, or the layout of the neighbour graph")
    p.add_argument("--benchmark", action="store_true", help="add the index benchmark to the summary")
    p.add_argument("--benchmark-sizes", default="1000,5000,10000")
    p.add_argument("--dup-threshold", type=float, default=0.97)
    p.add_argument("--target-size", type=int, default=120)
    p.add_argument("--max-samples", type=int, default=None, help="the most devkit samples that are read")
    p.add_argument("--prompts", default=None, help="text file of a prompt a line")
    p.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark, encoder = get_spark(), get_encoder(a.encoder)
    if a.source == "table":
        samples, batch = (spark.read.parquet(f"{a.dataroot}/{t}.parquet") for t in ("samples", "encoded_batch"))
        dim = len(batch.where(F.size("clip_image") > 0).select("clip_image").first()[0])
    else:
        samples = S.synthetic_samples(spark, a.n) if a.source == "synthetic" else S.nuscenes_samples(spark, a.dataroot, max_samples=a.max_samples)
        # the picture's features stand for the image where no model reads it
        batch, dim = encoder.encode_images(S.synthetic_features(samples), "sample_token", "features", 192), None
    if dim is None:
        spaces = batch.select(F.size("dinov2").alias("a"), F.size("clip_image").alias("b")).first()
        dim = spaces.b
        if spaces.a != dim:  # the pipeline compares vectors of one length; shorter ones are filled up with zeros, which keeps cosines
            fill = lambda c: F.concat(c, F.array_repeat(F.lit(0.0).cast("float"), F.lit(max(spaces)) - F.size(c))).alias(c)
            batch, dim = batch.select("sample_token", fill("dinov2"), fill("clip_image"), "backend"), max(spaces)
    lines = spark.read.text(a.prompts).where("trim(value) <> ''") if a.prompts else spark.createDataFrame([(t.replace("_", " "),) for t in S.TEMPLATES], "value string")
    texts = lines.take(10_001)
    if len(texts) > 10_000:
        raise SystemExit("more than 10,000 prompts")
    prompts = spark.createDataFrame([(i, r.value, [float(x) for x in encoder.encode_text(r.value, dim)]) for i, r in enumerate(texts)], "prompt_id int, prompt string, clip_text array<float>")
    sizes = tuple(int(x) for x in a.benchmark_sizes.split(",") if x.strip()) if a.benchmark else ()
    config = CurationConfig(source=a.source, encoder=encoder.backend, vector_backend=a.vector_backend, dup_threshold=a.dup_threshold, target_size=a.target_size, dim=dim, projection=a.projection, benchmark_sizes=sizes)
    if a.source != "table":  # pictures that can be decoded have thumbnails; the others have none
        files = S.synthetic_pictures(samples, 96) if a.source == "synthetic" else S.read_images(spark, f"{a.dataroot}/samples/CAM_FRONT").select(F.regexp_extract("path", r"(samples/CAM_FRONT/.*)$", 1).alias("cam_path"), "content").join(samples.select("cam_path", "sample_token"), "cam_path")
        S.decode_images(files, "sample_token").where("thumb is not null").select("sample_token", "thumb").write.mode("overwrite").parquet(f"{a.out}/thumbnails")
    line = CurationPipeline(config).run(samples, batch, prompts, a.out, sha=git_sha("."))
    print(line.select("headline_metric").first()[0])


if __name__ == "__main__":
    main()
