"""Explicit schemas of manifests, cues and lexicons; files are never inferred."""

from __future__ import annotations

MANIFEST = "audio_path string, transcript string, duration double, language string"
REVIEWED = (
    "audio_s3_key string, transcript string, duration double, language string, batch_name string, "
    "episode_label string, youtube_video_id string, chunk_index int, status string"
)
SIDECAR = "episode string, sentence string, buckets array<string>"
LEXICON = "spiritual_terms array<string>, arabic_phrases array<string>, english_domain array<string>"
CORRECTIONS = "corrections map<string,string>"
CUES = "video string, idx int, start double, end double, text string"
SIGNALS = "video string, rate int, samples array<double>"
