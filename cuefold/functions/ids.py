"""Identity in names and paths: video ids, episode labels, natural order, path parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name patterns.
VIDEO_ID = "^(?:.*_)?([A-Za-z0-9_-]{11})"
LABEL = "^[A-Za-z]+[0-9]+$"
FOLDER = r"^(EP\d+)_(.+)$"
EPISODE = r"^EP(\d+)"
AUDIO_EXTENSIONS = (".mp3", ".wav", ".m4a", ".aac", ".flac")
VIDEO_EXTENSIONS = (".mp4", ".mkv", ".webm")


def name(path: Column) -> Column:
    """After the last slash of either kind."""
    return F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)


def parent(path: Column) -> Column:
    parts = F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise("")


def stem(path: Column) -> Column:
    """The name without its last extension; a leading dot starts none."""
    return F.regexp_replace(name(path), r"(?s)(?<=.)\.[^.]+$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(name(path), r"(?s).(\.[^.]+)$", 1))


def youtube_id(path: Column) -> Column:
    """The rightmost 11 characters of [A-Za-z0-9_-] that begin the stem or follow an underscore; else null."""
    found = F.regexp_extract(stem(path), VIDEO_ID, 1)
    return F.when(found != "", found)


def video_name(path: Column, numbered: Column) -> Column:
    """label_id where the id follows nothing but an episode label; else `numbered`, with the id if there is one."""
    found, base = youtube_id(path), stem(path)
    # the id may occur again further right: what stands before its last occurrence counts
    at = F.length(base) - F.length(found) - F.instr(F.reverse(base), F.reverse(found)) + 1
    label = F.regexp_replace(base.substr(F.lit(1), at), "_+$", "")
    return F.when(found.isNull(), numbered).when(label.rlike(LABEL), F.concat_ws("_", label, found)).otherwise(F.concat_ws("_", numbered, found))


def video_id(path: Column, index: Column) -> Column:
    """video_name with vidNNNN; an index of more than four digits stays whole."""
    return video_name(path, F.format_string("vid%04d", index.cast("long")))


def natural_key(path: Column) -> Column:
    """Sorts digits by value and the rest by lower case. A name's runs are marked so that digits and letters compare as lists do.

    Digits without leading zeros follow their count, which ten digits hold for any string."""
    runs = F.regexp_extract_all(F.lower(name(path)), F.lit(r"(\d+|\D+)"), F.lit(1))

    def number(run: Column) -> Column:
        digits = F.ltrim(run, F.lit("0"))
        return F.concat(F.lit("0"), F.lpad(F.length(digits).cast("string"), 10, "0"), digits)

    return F.transform(runs, lambda run: F.when(run.rlike("^[0-9]+$"), number(run)).otherwise(F.concat(F.lit("1"), run)))


def episode_number(label: Column) -> Column:
    return F.coalesce(F.when(label.rlike(EPISODE), F.regexp_extract(label, EPISODE, 1).cast("int")), F.lit(0))


def chunk_index(path: Column) -> Column:
    """The number after the last underscore of the stem; anything else raises."""
    return F.substring_index(stem(path), "_", -1).cast("int")


def audio_path(root: Column, label: Column, video: Column, chunk: Column) -> Column:
    """root\\audio\\label_video\\label_video_NNN.wav, separated by backslashes."""
    folder = F.concat_ws("_", label, video)
    return F.concat(root, F.lit("\\audio\\"), folder, F.lit("\\"), F.format_string("%s_%03d.wav", folder, chunk))
