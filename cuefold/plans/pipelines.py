"""The steps from audio and subtitles to a dataset and its evaluation, each from files to files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuefold.batches import bounded
from cuefold.functions import ids
from cuefold.functions import text as T
from cuefold.operators import cues as C
from cuefold.operators import metrics as M
from cuefold.operators import pairing as P
from cuefold.operators import models, signals
from cuefold.operators import split as H
from cuefold.operators.numbering import numbered
from cuefold.sources import files, sinks
from cuefold.storage import written

MAX_PATHS = 100_000
#: Models that are evaluated together.
MAX_MODELS = 100


_CHUNKS = "video_id string, chunk_idx int, chunk_start double, chunk_end double, duration double, transcript string, samples binary, rate double"


def clips_of_pairs(spark: SparkSession, new: DataFrame, most: float, decode: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """The clips of pairs (pair_index, video_id, audio, subtitle), and path and error of files that can't be read or parsed."""
    part = F.floor((F.col("pair_index") - 1) / MAX_PATHS)  # pairs are read in parts of MAX_PATHS, until none is left
    chunks, failed = spark.createDataFrame([], _CHUNKS), spark.createDataFrame([], "path string, error string")
    for k in sorted(r.part for r in new.select(part.alias("part")).distinct().collect()):
        own = new.where(part == k)
        todo = own.select("audio", "subtitle").collect()  # MAX_PATHS rows at most
        named = F.broadcast(own.select(ids.stem(F.col("audio")).alias("video"), ids.stem(F.col("subtitle")).alias("sub"), "video_id", "audio", "subtitle"))
        blocks = written(files.audio_blocks(spark, [r.audio for r in todo], decode=decode).join(named.drop("sub"), "video"), "signals")
        texts = files.subtitles(spark, [r.subtitle for r in todo]).withColumnRenamed("video", "sub").join(named, "sub")
        cues = written(C.parse_subtitles(texts, "video_id", strict=False), "cues")
        unread = blocks.where("error IS NOT NULL").groupBy(F.col("audio").alias("path")).agg(F.min("error").alias("error"))
        unparsed = texts.join(cues.select("video_id").distinct(), "video_id", "left_anti").select(F.col("subtitle").alias("path"), F.lit("no cue, or a time that can't be read").alias("error"))
        failed = failed.unionByName(unread).unionByName(unparsed)
        sound = blocks.join(F.broadcast(unread.select(F.col("path").alias("audio"))), "audio", "left_anti").select("video_id", "block", "rate", "total", "samples")
        chunks = chunks.unionByName(written(signals.chunks_of_blocks(cues, sound, "video_id", most), "chunks"))
    return chunks, written(failed, "failed")


def _samples(chunks: DataFrame, new: DataFrame, output_dir: str) -> DataFrame:
    path = F.format_string(f"{output_dir}/audio/%s/%s_%03d.wav", "video_id", "video_id", "chunk_idx")
    rows = chunks.join(new.select("video_id", "pair_index"), "video_id")
    return rows.select((F.col("pair_index") * 1_000_000 + F.col("chunk_idx")).alias("at"), path.alias("audio_path"), "transcript", "duration", F.lit("ur").alias("language"))


def prepare_batch(
    spark: SparkSession, input_dir: str, output_dir: str, most: float = C.MAX_DURATION, decode: Callable | None = None,
    report: Callable[[DataFrame], None] | None = None, manifest: str = "manifest.json",
) -> tuple[DataFrame, DataFrame]:
    """Pairs of audio and subtitles that the manifest lacks become clips; the merged manifest and the clips are returned.

    Numbers of videos without a label follow the natural order of the listing. A file that can't be read or parsed is left
    out and tried again by the next call; `report` gets path and error of all such files. `manifest` names a folder of JSON
    lines, an array if it ends in .json, or an append-only log if it ends in .log: then only the new samples are returned,
    for the log to take on; nothing that is there is read but its paths, and nothing is written again."""
    found = files.listing(spark, input_dir)
    audio, srt = P.identified(found, ids.AUDIO_EXTENSIONS), P.identified(found, (".srt",))
    paired = P.pairs(audio, srt).withColumn("video_id", ids.video_id(F.col("audio"), F.col("pair_index")))
    done = files.optional_manifest(spark, f"{output_dir}/{manifest}")
    new = written(P.unseen(paired, done.select(ids.parent(F.col("audio_path")).alias("video_id"))), "new_pairs")
    chunks, failed = clips_of_pairs(spark, new, most, decode)
    if report:
        report(failed)
    if manifest.endswith(".log"):
        rows = _samples(chunks, new, output_dir).withColumnRenamed("at", "pos")
        return written(_renumbered(rows), "merged"), sinks.clips(chunks.withColumnRenamed("video_id", "video"))
    merged = done.select(F.lit(0).alias("old"), F.col("pos").alias("at"), "audio_path", "transcript", "duration", "language")
    merged = merged.unionByName(_samples(chunks, new, output_dir).select(F.lit(1).alias("old"), "*"))
    merged = merged.select(F.struct("old", "at").alias("pos"), "audio_path", "transcript", "duration", "language")
    return written(_renumbered(merged), "merged"), sinks.clips(chunks.withColumnRenamed("video_id", "video"))


def _renumbered(rows: DataFrame) -> DataFrame:
    return numbered(rows.withColumnRenamed("pos", "_pos"), [F.col("_pos")], "pos").withColumn("pos", F.col("pos") - 1).drop("_pos")


def prepare_pair(
    spark: SparkSession, audio: str, subtitle: str, output_dir: str, most: float = C.MAX_DURATION, index: int = 1, decode: Callable | None = None
) -> tuple[DataFrame, DataFrame]:
    """The manifest and the clips of one recording; a file that can't be read or parsed raises."""
    one = spark.createDataFrame([(index, audio, subtitle)], "pair_index long, audio string, subtitle string")
    new = written(one.withColumn("video_id", ids.video_id(F.col("audio"), F.col("pair_index"))), "new_pairs")
    chunks, failed = clips_of_pairs(spark, new.withColumn("pair_index", F.lit(1).cast("long")), most, decode)
    if bad := failed.take(1):
        raise ValueError(f"{bad[0].path}: {bad[0].error}")
    rows = _samples(chunks, new, output_dir).withColumnRenamed("at", "pos")
    return written(_renumbered(rows), "samples"), sinks.clips(chunks.withColumnRenamed("video_id", "video"))


def flat_prep(spark: SparkSession, media: DataFrame, transcript_dir: str) -> DataFrame:
    """media (path, duration) joined to transcripts by stem; valid texts of files short enough become samples."""
    rows = judged_media(spark, media, transcript_dir).where("reason IS NULL")
    return rows.select(F.col("path").alias("audio_path"), "transcript", "duration", F.lit("ur").alias("language"))


def judged_media(spark: SparkSession, media: DataFrame, transcript_dir: str) -> DataFrame:
    """media with transcript and reason: why a file becomes no sample (null: it does)."""
    texts = files.whole_texts(spark, f"{transcript_dir}/*.txt").select(ids.stem(F.col("path")).alias("stem"), F.col("value").alias("transcript"))
    rows = media.withColumn("stem", ids.stem(F.col("path"))).join(texts, "stem", "left").drop("stem")
    reason = F.when(F.col("transcript").isNull(), "no transcript").when(~T.valid_transcript(F.col("transcript")), "invalid transcript")
    return rows.withColumn("reason", reason.when(F.col("duration").isNull(), "unreadable").when(F.col("duration") > C.MAX_DURATION, "too long"))


def flat_batch(spark: SparkSession, input_dir: str, transcript_dir: str, output_dir: str, decode: Callable | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Media of a folder with transcripts of the same stem: the samples, the decoded audio (path, content), and path and reason of the rest."""
    media = files.videos(spark, input_dir).unionByName(files.listing(spark, input_dir, ids.AUDIO_EXTENSIONS)).select("path", ids.stem(F.col("path")).alias("video"))
    blocks = written(files.audio_blocks(spark, f"{input_dir}/*", decode=decode).join(media, "video"), "signals")
    lengths = blocks.groupBy("path", "video").agg(F.when(F.max("error").isNull(), F.max("total") / F.max("rate")).alias("duration"))
    judged = judged_media(spark, lengths, transcript_dir)
    judged = written(judged, "judged")
    out = F.concat(F.lit("audio/"), "video", F.lit(".wav"))
    kept = judged.where("reason IS NULL").withColumn("audio_path", F.concat(F.lit(f"{output_dir}/"), out))
    samples = numbered(kept.select("audio_path", "transcript", "duration", F.lit("ur").alias("language")), [ids.natural_key(F.col("audio_path")), F.col("audio_path")], "pos")
    # what is kept lasts MAX_DURATION at most, which is less than a block
    waves = sinks.waves(blocks.where("block = 0").join(kept.select("video"), "video").select(out.alias("path"), "samples", "rate"))
    return written(samples.withColumn("pos", F.col("pos") - 1), "samples"), waves, judged.where("reason IS NOT NULL").select("path", "reason")


def totals(samples: DataFrame) -> DataFrame:
    """clips, videos and hours of a manifest."""
    return samples.agg(F.count("*").alias("clips"), F.count_distinct(ids.parent(F.col("audio_path"))).alias("videos"), (F.sum("duration") / 3600).alias("hours"))


def normalise_manifest(spark: SparkSession, path: str, in_place: bool = False, dry_run: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rewritten manifest, rule totals and the log of changes; written unless dry_run."""
    rows = written(files.manifest(spark, path), "manifest")  # what is read later must not see what is written
    after = T.normalise(rows)
    report, log = T.rule_totals(after), T.changed_log(rows)
    out = after.drop("hits", "changed")
    if not dry_run:
        sinks.manifest(out, sinks.normalised_path(path, in_place))
    return out, report, log


def convert_reviewed(
    spark: SparkSession, reviewed_path: str, processed_dir: str, batch_folder: str | None = None, output: str | None = None,
    output_name: str = "manifest_reviewed.json", allow_reconstruct: bool = False, report: Callable[[DataFrame, DataFrame], None] | None = None,
    manifests: tuple[str, ...] = files.MANIFESTS,
) -> tuple[DataFrame, DataFrame]:
    """The reviewed manifest with local paths, and coverage by episode, in order. Rows that match nothing raise unless
    reconstruction is allowed; before, `report` gets the summary over all and the folders that rows were found in."""
    rows = files.reviewed(spark, reviewed_path).withColumnsRenamed({"episode_label": "episode", "youtube_video_id": "yt_id"})
    local = files.manifests(spark, processed_dir, manifests)
    if batch_folder:
        lookup = P.local_lookup(local.where(F.col("folder") == batch_folder).withColumn("live", F.lit(True)))
    else:
        there = files.below(spark, processed_dir, "*.wav").where(F.col("path").rlike("/[^/]+/audio/[^/]+/[^/]+$"))
        lookup = P.merge_lookups(P.local_lookup(files.mark_live(local, there)))
    joined = written(P.join_back(rows, lookup, F.lit(f"data\\processed\\{batch_folder or ''}")), "joined")
    coverage = P.in_order(P.coverage(joined))
    if report:
        report(P.coverage_summary(joined), P.coverage_folders(rows, lookup))
    P.gate(joined, allow_reconstruct, batch_folder is not None)
    out = joined.select("pos", "audio_path", "transcript", "duration", "language")
    sinks.manifest(out, sinks.converted_path(processed_dir, output, batch_folder, output_name))
    return out, coverage


def fix_lexicon(spark: SparkSession, path: str, output: str, pairs: list[tuple[str, str]]) -> tuple[DataFrame, int]:
    """The manifest with literal replacements, written to output, and the number of changed rows."""
    rows = written(files.manifest(spark, path), "manifest")  # the output may be the input
    fixed = bounded(rows).withColumn("_fixed", T.replace_chain(F.col("transcript"), pairs))
    changed = fixed.where(F.col("_fixed") != F.col("transcript")).count()
    out = fixed.withColumn("transcript", F.col("_fixed")).drop("_fixed")
    sinks.manifest(out, output)
    return out, changed


def build_dataset(
    spark: SparkSession, manifest: str, output: str, share: float = 0.1, forced: list[str] | None = None, terms_path: str | None = None, short_labels: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows with audio, sentence, language, episode, buckets and split, written by split with a sidecar; and bucket counts."""
    rows = files.manifest(spark, manifest).withColumn("episode", ids.parent(F.col("audio_path")))
    rows = rows.withColumn("buckets", T.buckets(F.col("transcript"), files.terms(spark, terms_path) if terms_path else []))
    rich = F.array_contains("buckets", "code_switch") | (F.size("buckets") > 1)
    held = H.forced_groups(rows, "episode", forced, short_labels) if forced else H.held_groups(rows, "episode", rich, share)
    rows = H.split_rows(rows, held, "episode").select(
        "pos", F.col("audio_path").alias("audio"), F.col("transcript").alias("sentence"), F.coalesce("language", F.lit("ur")).alias("language"), "episode", "buckets", "split"
    )
    rows = written(rows, "split")
    if not H.leaks(rows, "episode").isEmpty():
        raise ValueError("a group is in both splits")
    sinks.dataset(rows, output)
    sinks.sidecar(rows, f"{output}/eval_buckets.json" if "://" in output else output.rstrip("/") + "_eval_buckets.json")
    return rows, H.bucket_counts(rows)


def evaluate(predictions: DataFrame, which: str = "both") -> DataFrame:
    """model, bucket (null: all), n, raw_wer, norm_wer of predictions (model, reference, prediction, buckets)."""
    rows = predictions if which == "both" else predictions.where(F.col("model") == which)
    raw = M.wer(M.edits(rows), ["model"]).select("model", F.lit(None).cast("string").alias("bucket"), "n", F.col("wer").alias("raw_wer"))
    norm = M.wer(M.edits(rows, True), ["model"]).select("model", F.col("wer").alias("norm_wer"))
    by = M.wer_by_bucket(rows, ["model"]).select("model", "bucket", "n", F.lit(None).cast("double").alias("raw_wer"), F.col("wer").alias("norm_wer"))
    return raw.join(norm, "model").unionByName(by)


def evaluate_with_sidecar(predictions: DataFrame, sidecar: DataFrame | None, which: str = "both") -> tuple[DataFrame, str | None]:
    """As evaluate, of predictions (model, pos, reference, prediction) and the sidecar (pos, sentence, buckets) as they come; and
    why the rates are overall only, if they are: there is no sidecar, or some model's references aren't its sentences."""
    rows = predictions if which == "both" else predictions.where(F.col("model") == which)
    why = None if sidecar is not None else "no sidecar"
    if why is None:
        for model in [r.model for r in rows.select("model").distinct().limit(MAX_MODELS).collect()]:
            own = rows.where(F.col("model").eqNullSafe(model)).select("pos", F.col("reference").alias("sentence"))
            first = M.first_difference(sidecar.select("pos", "sentence"), own)
            if first is not None:
                n = sidecar.count(), own.count()
                why = f"{model}: the sidecar has {n[0]} rows, the predictions {n[1]}; they differ first at position {first}"
                break
    if why is None:
        joined = rows.drop("buckets").join(sidecar.select("pos", "buckets"), "pos")
    else:
        joined = rows.withColumn("buckets", F.array().cast("array<string>"))
    return evaluate(joined), why


def transcribe(spark: SparkSession, paths: list[str], load: Callable, label: str) -> DataFrame:
    """path, transcript, error, out: a caller's model over whole files, those that don't exist skipped; out is stem_label.txt."""
    rows = models.transcribe_bytes(files.listed(spark, paths), load)
    return rows.withColumn("out", F.concat(ids.stem(F.col("path")), F.lit(f"_{label}.txt")))
