"""Views of the driver's tables as clips, cues, reviews and predictions; each in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuefold.operators import signals as G
from cuefold.storage import written

SALLA, AS, ZWNJ = "ﷺ", "ؑ", "‌"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("pos"), F.col("source").alias("episode"), F.col("text").alias("transcript"), (F.col("n_chars") / 16.0).alias("duration"), F.col("lang").alias("language"))


CLIPS = "clips AS (SELECT doc_id AS pos, source AS episode, text AS transcript, n_chars / 16.0 AS duration, lang AS language FROM documents)"


def clips_ur(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips with Arabic punctuation and marks, so that every rewrite rule fires."""
    t = F.translate("transcript", ".,?", "۔،؟")
    for a, b in ((" the ", f" {SALLA} "), (" of ", f"{AS} "), (" in ", f"{ZWNJ} in "), ("er۔", "er ۔")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return clips(spark, sf_dir).withColumn("transcript", t)


CLIPS_UR = (
    CLIPS
    + f""", clips_ur AS (SELECT pos, episode, duration, language, replace(replace(replace(replace(translate(transcript, '.,?', '۔،؟'), ' the ', ' {SALLA} '),
  ' of ', '{AS} '), ' in ', '{ZWNJ} in '), 'er۔', 'er ۔') AS transcript FROM clips)"""
)


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as cues: 32 characters a second, a gap before each, every third ended by a stop or a comma. Times are multiples of 1/32."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("video"), F.col("turn").cast("int").alias("idx"), "conv_id", "turn", "text")
    last = F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, "۔").when((F.col("conv_id") + F.col("turn")) % 3 == 1, "،").otherwise("")
    long_ = F.length("text") / 32.0
    wait = ((F.col("turn") * 7) % 9) * 0.5
    until = F.sum(long_ + wait).over(Window.partitionBy("video").orderBy("idx"))
    body = F.expr("substring(text, 1, greatest(length(text) - 1, 0))")
    return c.select("video", "idx", (until - long_).alias("start"), until.alias("end"), F.concat(body, last).alias("text"))


CUES = """t AS (SELECT CAST(conv_id AS VARCHAR) AS video, CAST(turn AS INTEGER) AS idx, length(text) / 32.0 AS long_, ((turn * 7) % 9) * 0.5 AS wait,
  substr(text, 1, greatest(length(text) - 1, 0)) || CASE (conv_id + turn) % 3 WHEN 0 THEN '۔' WHEN 1 THEN '،' ELSE '' END AS text FROM conversations),
cues AS (SELECT video, idx, CAST(sum(long_ + wait) OVER w - long_ AS DOUBLE) AS start, CAST(sum(long_ + wait) OVER w AS DOUBLE) AS "end", text FROM t
  WINDOW w AS (PARTITION BY video ORDER BY idx))"""


def files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Audio and subtitle paths of documents: each document has one of both at least. Which, its language and length say."""
    yt = F.concat(F.lit("x"), F.lpad(F.col("doc_id").cast("string"), 10, "0"))
    d = table(spark, sf_dir, "documents")
    audio = d.where("lang <> 'de'").select(F.concat(F.lit("in/EP"), (F.col("doc_id") % 50).cast("string"), F.lit("_"), yt, F.lit(".mp3")).alias("path"))
    srt = d.where("lang = 'de' OR lang IS NULL OR n_chars % 2 = 0").select(F.concat(F.lit("in/sub_"), yt, F.lit(".srt")).alias("path"))
    return audio, srt


FILES = """audio AS (SELECT 'x' || lpad(CAST(doc_id AS VARCHAR), 10, '0') AS yt_id, 'in/EP' || (doc_id % 50) || '_x' || lpad(CAST(doc_id AS VARCHAR), 10, '0') || '.mp3' AS path FROM documents WHERE lang <> 'de'),
srt AS (SELECT 'x' || lpad(CAST(doc_id AS VARCHAR), 10, '0') AS yt_id, 'in/sub_x' || lpad(CAST(doc_id AS VARCHAR), 10, '0') || '.srt' AS path FROM documents WHERE lang = 'de' OR lang IS NULL OR n_chars % 2 = 0)"""

#: Folders of local manifests: root, whose documents are in it, and which of its paths are live.
_FOLDERS = (
    ("batch_a", "processed", "lang <> 'de' OR lang IS NULL", "n_chars % 5 <> 0"),
    ("batch_b", "processed", "n_chars % 2 = 0", "floor(n_chars / 5) % 3 <> 0"),
    ("batch_a", "redone", "n_chars % 11 = 0 AND (lang <> 'de' OR lang IS NULL)", "true"),
)


def _key(d: DataFrame) -> DataFrame:
    """Seven chunks make a video, and videos make fifty episodes, so keys grow with the table."""
    video = F.floor(F.col("doc_id") / 7)
    return d.select(
        "*", F.concat(F.lit("EP"), (video % 50).cast("string")).alias("episode"), F.concat(F.lit("x"), F.lpad(video.cast("string"), 10, "0")).alias("yt_id"),
        (F.col("doc_id") % 7).cast("int").alias("chunk_index"),
    )


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of local manifests that overlap and differ in which paths are live; some keys come twice in a folder, some in none."""
    d = _key(table(spark, sf_dir, "documents"))
    label = F.concat_ws("_", "episode", "yt_id")
    name = F.concat(label, F.lit("_"), F.lpad(F.col("chunk_index").cast("string"), 3, "0"), F.lit(".wav"))
    out = None
    for k, (folder, root, where, live) in enumerate(_FOLDERS):
        path = F.concat(F.lit(f"data\\{root}\\{folder}\\audio\\"), label, F.lit("\\"), name)
        one = d.where(where).select(F.lit(folder).alias("folder"), (F.col("doc_id") * 4 + k).alias("pos"), path.alias("audio_path"), F.expr(live).alias("live"))
        out = one if out is None else out.unionByName(one)
    return out


_LABEL = "'EP' || (doc_id // 7) % 50 || '_x' || lpad(CAST(doc_id // 7 AS VARCHAR), 10, '0')"
_KEY = "'EP' || (doc_id // 7) % 50 AS episode, 'x' || lpad(CAST(doc_id // 7 AS VARCHAR), 10, '0') AS yt_id, CAST(doc_id % 7 AS INTEGER) AS chunk_index"


def _one(k: int, folder: str, root: str, where: str, live: str) -> str:
    path = f"'data\\{root}\\{folder}\\audio\\' || {_LABEL} || '\\' || {_LABEL} || '_' || lpad(CAST(doc_id % 7 AS VARCHAR), 3, '0') || '.wav'"
    return f"SELECT '{folder}' AS folder, doc_id * 4 + {k} AS pos, {path} AS audio_path, {live} AS live, {_KEY} FROM documents WHERE {where}"


MANIFESTS = f"""manifests AS ({" UNION ALL ".join(_one(k, *f) for k, f in enumerate(_FOLDERS))}),
lookups AS (SELECT * FROM manifests QUALIFY row_number() OVER (PARTITION BY folder, episode, yt_id, chunk_index ORDER BY pos DESC) = 1),
lookup AS (SELECT * FROM lookups QUALIFY row_number() OVER (PARTITION BY episode, yt_id, chunk_index ORDER BY NOT live, folder) = 1)"""


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviewed chunks; some are of no local manifest."""
    d = _key(table(spark, sf_dir, "documents"))
    return d.select("episode", "yt_id", "chunk_index", F.col("doc_id").alias("pos"), F.col("text").alias("transcript"), (F.col("n_chars") / 16.0).alias("duration"), F.col("lang").alias("language"))


REVIEWED = f"reviewed AS (SELECT {_KEY}, doc_id AS pos, text AS transcript, n_chars / 16.0 AS duration, lang AS language FROM documents)"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a reference with the predictions of two models."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("reference"))
    words = F.size(F.array_distinct(F.split("reference", " ")))
    base = F.replace(F.replace("reference", F.lit(" la "), F.lit(" ")), F.lit(" the "), F.lit(" a "))
    tuned = F.replace("reference", F.lit(" of "), F.lit(" off of "))
    buckets = F.array(F.when(F.col("reference").rlike("[À-ÿ]"), "accented").otherwise("plain"), F.when(words > 40, "long").otherwise("short"))
    rows = c.withColumn("buckets", buckets)
    return rows.withColumn("model", F.lit("base")).withColumn("prediction", base).unionByName(rows.withColumn("model", F.lit("finetuned")).withColumn("prediction", tuned))


_PAIRS = """SELECT conv_id, turn, text AS reference, '{model}' AS model, {prediction} AS prediction,
  [CASE WHEN regexp_matches(text, '[À-ÿ]') THEN 'accented' ELSE 'plain' END, CASE WHEN len(list_distinct(string_split(text, ' '))) > 40 THEN 'long' ELSE 'short' END] AS buckets
  FROM conversations"""
PREDICTIONS = (
    "predictions AS ("
    + _PAIRS.format(model="base", prediction="replace(replace(text, ' la ', ' '), ' the ', ' a ')")
    + " UNION ALL "
    + _PAIRS.format(model="finetuned", prediction="replace(text, ' of ', ' off of ')")
    + ")"
)


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("samples"))


def long_signals(spark: SparkSession, sf_dir: str, size: int = G.SIZE) -> DataFrame:
    """The vectors of each label end to end, in order of vec_id, as one signal of 64 samples a second, in blocks of `size` samples."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").cast("string").alias("video"), "vec_id", "embedding")
    end = F.sum(F.size("embedding")).over(Window.partitionBy("video").orderBy("vec_id").rowsBetween(Window.unboundedPreceding, 0))
    pieces = rows.select("video", F.lit(64).alias("rate"), (end - F.size("embedding")).alias("at"), G.pack(F.col("embedding")).alias("samples"))
    return written(G.reblocked(pieces, size=size), "blocks")  # read several times


LONG_SIGNALS = """long_signals AS (SELECT CAST(label AS VARCHAR) AS video, flatten(list(list_transform(embedding, lambda x: CAST(x AS DOUBLE)) ORDER BY vec_id)) AS s FROM embeddings GROUP BY label)"""


TERMS = ["solo", "eaux", "licht", "thing of"]
LATIN = "[À-ÿ]"
