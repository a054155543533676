"""Incremental runs of the row-wise silver builds over file streams."""

from tierforge.streaming.incremental import row_wise_builds, stream_silver  # noqa: F401
