"""File streams of landed pages."""

from folioflow.streaming.landing import landing_stream, stage_pages, staged_pages

__all__ = ["landing_stream", "stage_pages", "staged_pages"]
