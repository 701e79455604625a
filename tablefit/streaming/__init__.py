"""Scoring on a stream.

The original pipeline is batch only. Scoring is a pure projection (B1, P6),
so the same expressions apply unchanged to a streaming DataFrame; this module
only wires a file source and sink with a checkpoint under the shared folder.
"""

from tablefit.streaming.score import score_stream, start_scoring_stream  # noqa: F401
