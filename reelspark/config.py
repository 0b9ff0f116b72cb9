"""Thresholds of the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ExtractConfig:
    blur_threshold: float = 100.0
    first_sharp_tries: int = 10
    first_step_ms: int = 33
    long_scene_ms: int = 30_000
    long_scene_step_ms: int = 5_000
    pixel_delta: int = 30
    pixel_share: float = 0.15
    ocr_confidence: float = 0.5
    scene_threshold: float = 27.0
    scene_min_len_s: float = 0.3


@dataclass(frozen=True)
class ChunkConfig:
    min_ms: int = 5_000
    max_ms: int = 60_000
    split_long: bool = False
    chrome_share: float = 0.8
    dedup_overlap: float = 0.9
    description_chars: int = 500
    text_dim: int = 384
    image_dim: int = 512
    embed_batch: int = 8


@dataclass(frozen=True)
class ReviewConfig:
    window_ms: int = 5_000
    keyframe_gap_ms: int = 15_000
    severe_gap_ms: int = 30_000
    asr_gap_ms: int = 5_000
    min_text_chars: int = 10
    low_confidence: float = 0.5
    top: int = 3
    flags_shown: int = 20
    include_edges: bool = False
    pairs_per_chunk: int = 3
