"""The same pipelines applied to streams."""

from .scoring import (
    SendOnce,
    key_prediction_lines,
    read_once,
    score_batches,
    score_keys,
    score_labels,
    score_sound_labels,
    send_batches,
    set_broken_aside,
)

__all__ = [
    "SendOnce",
    "key_prediction_lines",
    "read_once",
    "score_batches",
    "score_keys",
    "score_labels",
    "score_sound_labels",
    "send_batches",
    "set_broken_aside",
]
