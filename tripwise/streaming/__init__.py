"""Structured Streaming form of prediction mode: score trip files as they arrive."""

from tripwise.streaming.predict import start_prediction_stream

__all__ = ["start_prediction_stream"]
