"""Command line: python -m cuefold <command>."""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cuefold.functions import text as T
from cuefold.plans import pipelines
from cuefold.shipping import ship
from cuefold.sources import files, sinks
from cuefold.storage import scope


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cuefold")
    commands = top.add_subparsers(dest="command", required=True)
    p = commands.add_parser("prepare-batch", help="pairs of audio and subtitles to clips and a manifest")
    p.add_argument("--input_dir", required=True)
    p.add_argument("--output_dir", default="./data/processed")
    p.add_argument("--max_duration", type=float, default=28.0)
    p.add_argument("--manifest-name", default="manifest.json", help="an array if it ends in .json, an append-only log if it ends in .log, else a folder of JSON lines")
    p.add_argument("--decoder", help="module:function, bytes to rate and samples, for audio other than WAV")
    p = commands.add_parser("prepare-pair", help="one recording and its subtitles to clips and a manifest")
    p.add_argument("--audio", required=True)
    p.add_argument("--srt", required=True)
    p.add_argument("--output_dir", default="./data/processed/sample_test")
    p.add_argument("--max_duration", type=float, default=28.0)
    p.add_argument("--video_index", type=int, default=1)
    p.add_argument("--decoder")
    p = commands.add_parser("prepare-flat", help="media and transcripts of the same name to a manifest")
    p.add_argument("--input_dir", required=True)
    p.add_argument("--transcript_dir", required=True)
    p.add_argument("--output_dir", default="./data/processed")
    p.add_argument("--decoder")
    p = commands.add_parser("transcribe", help="files through a caller's model; a table of path, transcript and error")
    p.add_argument("paths", nargs="+")
    p.add_argument("--model", required=True, help="module:function that loads a function of a list of bytes")
    p.add_argument("--out")
    p = commands.add_parser("compare", help="files through two models, a text file each")
    p.add_argument("paths", nargs="+")
    p.add_argument("--base", required=True)
    p.add_argument("--finetuned", required=True)
    p.add_argument("--out_dir", required=True)
    p = commands.add_parser("normalise", help="rewrite a manifest's transcripts")
    p.add_argument("--manifest", required=True)
    p.add_argument("--inplace", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p = commands.add_parser("convert", help="a reviewed manifest with local paths")
    p.add_argument("reviewed_manifest")
    p.add_argument("--processed-dir", default="data/processed")
    p.add_argument("--batch-folder")
    p.add_argument("--manifest-name", action="append", help="of the local manifests; manifest.json and manifest.jsonl if none is given")
    p.add_argument("--output")
    p.add_argument("--output-name", default="manifest_reviewed.json")
    p.add_argument("--allow-reconstruct", action="store_true")
    p = commands.add_parser("fix-lexicon", help="literal replacements, a JSON array of pairs")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--pairs", required=True)
    p = commands.add_parser("build-dataset", help="whole-group holdout")
    p.add_argument("manifest")
    p.add_argument("output")
    p.add_argument("--eval-split", type=float, default=0.10)
    p.add_argument("--eval-episodes", type=lambda s: [x.strip() for x in s.split(",") if x.strip()])
    p.add_argument("--domain-terms")
    p = commands.add_parser("prompt", help="a prompt of domain terms")
    p.add_argument("--terms", required=True)
    p.add_argument("--max-terms", type=int, default=20)
    p.add_argument("--out")
    p = commands.add_parser("evaluate", help="word error rates of a Parquet table of predictions")
    p.add_argument("predictions")
    p.add_argument("--sidecar", help="of predictions that hold no buckets: an array of episode, sentence and buckets in their order")
    p.add_argument("--which", choices=("base", "finetuned", "both"), default="both")
    p.add_argument("--out")
    return top


def named(spec: str | None, default=None):
    """The object that module:name names."""
    if not spec:
        return default
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("cuefold").getOrCreate()
    ship(spark)
    with scope():  # shared tables go when the command has ended
        run(spark, a)


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.command == "prepare-batch":
        report = lambda failed: failed.show(1000, truncate=False)
        merged, clips = pipelines.prepare_batch(spark, a.input_dir, a.output_dir, a.max_duration, named(a.decoder), report, a.manifest_name)
        sinks.wav_files(clips, a.output_dir)
        sinks.manifest(merged, f"{a.output_dir}/{a.manifest_name}")
        pipelines.totals(merged).show()
    elif a.command == "prepare-pair":
        rows, clips = pipelines.prepare_pair(spark, a.audio, a.srt, a.output_dir, a.max_duration, a.video_index, named(a.decoder))
        sinks.wav_files(clips, a.output_dir)
        sinks.manifest(rows, f"{a.output_dir}/manifest.json")
        pipelines.totals(rows).show()
    elif a.command == "prepare-flat":
        rows, waves, rest = pipelines.flat_batch(spark, a.input_dir, a.transcript_dir, a.output_dir, named(a.decoder))
        sinks.wav_files(waves, a.output_dir)
        sinks.manifest(rows, f"{a.output_dir}/manifest.json")
        rest.show(1000, truncate=False)
        pipelines.totals(rows).show()
    elif a.command == "transcribe":
        rows = pipelines.transcribe(spark, a.paths, named(a.model), "model").drop("out")
        sinks.json_lines(rows, a.out) if a.out else rows.show(1000, truncate=False)
    elif a.command == "compare":
        for label in ("base", "finetuned"):
            for r in pipelines.transcribe(spark, a.paths, named(getattr(a, label)), label).toLocalIterator():
                print(r.out, r.error or "")
                if r.error is None:
                    sinks.text(spark, r.transcript, f"{a.out_dir}/{r.out}")
    elif a.command == "normalise":
        _, report, log = pipelines.normalise_manifest(spark, a.manifest, a.inplace, a.dry_run)
        report.show(truncate=False)
        log.select("pos", "rules", F.substring("before", 1, 120).alias("before"), F.substring("after", 1, 120).alias("after")).show(truncate=False)
    elif a.command == "convert":
        report = lambda summary, folders: (summary.show(truncate=False), folders.show(1000, truncate=False))
        _, coverage = pipelines.convert_reviewed(spark, a.reviewed_manifest, a.processed_dir, a.batch_folder, a.output, a.output_name, a.allow_reconstruct, report, tuple(a.manifest_name or files.MANIFESTS))
        coverage.show(1000, truncate=False)
    elif a.command == "fix-lexicon":
        pairs = [tuple(p) for p in json.loads(files.whole_texts(spark, a.pairs).first().value)]
        print(pipelines.fix_lexicon(spark, a.input, a.output, pairs)[1], "rows changed")
    elif a.command == "build-dataset":
        _, counts = pipelines.build_dataset(spark, a.manifest, a.output, a.eval_split, a.eval_episodes, a.domain_terms)
        counts.show()
    elif a.command == "prompt":
        groups = files.lexicon(spark, a.terms)
        column = lambda name: F.array(*[F.lit(t) for t in groups[name]]).cast("array<string>")
        prompt = T.prompt([(column("spiritual_terms"), "، ", "۔"), (column("arabic_phrases"), "، ", "۔"), (column("english_domain"), ", ", ".")], most=a.max_terms)
        text = spark.range(1).select(prompt).first()[0]
        sinks.text(spark, text, a.out) if a.out else print(text)
    elif a.command == "evaluate":
        given = spark.read.parquet(a.predictions)
        if "buckets" in given.columns and not a.sidecar:
            rows = pipelines.evaluate(given, a.which)
        else:
            rows, why = pipelines.evaluate_with_sidecar(given, files.sidecar(spark, a.sidecar) if a.sidecar else None, a.which)
            if why:
                print(f"overall rates only: {why}")
        sinks.metrics(rows, a.out) if a.out else rows.show(1000, truncate=False)


if __name__ == "__main__":
    main()
