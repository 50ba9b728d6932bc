"""The operators bound to the driver's tables, each with the SQL that gives the same rows."""

from . import bind_align, bind_curate, bind_frames, bind_integrity, bind_learning, bind_long, bind_release, bind_segment, bind_trees

_PARTS = (bind_align, bind_segment, bind_curate, bind_integrity, bind_frames, bind_release, bind_long, bind_trees, bind_learning)
QUERIES = {name: f for part in _PARTS for name, f in part.R.queries.items()}
SQL = {name: text for part in _PARTS for name, text in part.R.sql.items()}
