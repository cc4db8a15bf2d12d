"""Schemas of the files: shard entries, manifests, records, batch markers, attempts."""

from __future__ import annotations

VIDEO = (
    "id string, title string, channel_id string, channel_title string, published_at string, duration_s long, license string, live string, "
    "age_restricted boolean, made_for_kids boolean, privacy string, language string"
)
ENTRY = f"{VIDEO}, source string"
BATCH = "batch string, created_at string, shards long, videos long, shard_size long"
MANIFEST = "id string, status string, reason string, bytes long, duration_s long"
RECORD = (
    "id string, url string, title string, channel_id string, channel_title string, channel_url string, license string, published_at string, duration_s long, "
    "batch string, shard long, worker string, fetched_at string, files array<struct<path: string, bytes: long, sha256: string>>"
)
ATTEMPT = "id long, ts_us long, worker string, label string, provider string, video string, outcome string, bytes long, seconds double, duration_s long"
EVENT = "video string, at_us long, eid long, kind string, worker string, hold_s int, state string, bytes long"
