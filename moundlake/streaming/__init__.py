"""Structured Streaming ingest of landed game-feed files (ST1)."""

from moundlake.streaming.boards import MomentBoard  # noqa: F401
from moundlake.streaming.ingest import current_pitches, start_feed_ingest  # noqa: F401
from moundlake.streaming.plays import current_plays, play_states, stage_documents, start_play_state  # noqa: F401
