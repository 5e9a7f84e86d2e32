"""Structured Streaming forms of the staging loads.  The source reports are
batch only; the incremental staging load (W2) is the one operator with a
natural streaming form."""

from .incremental import single_file_glob, stage_new_files, start_staging_stream

__all__ = ["single_file_glob", "stage_new_files", "start_staging_stream"]
