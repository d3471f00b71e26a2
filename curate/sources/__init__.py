"""Sources: text lines and sections, permissive CSV, archives, step logs, tables."""

from curate.sources.archive import expand_archives
from curate.sources.csv import (header_names, read_permissive_csv, split_corrupt,
                                write_bad_records)
from curate.sources.lines import (read_lines, route_sections, section_headers, section_to_dim,
                                  split_sections)
from curate.sources.steplog import read_step_log
from curate.sources.tables import load, read_table

__all__ = [
    "expand_archives", "header_names", "load", "read_lines", "read_permissive_csv",
    "read_step_log", "read_table", "route_sections", "section_headers", "section_to_dim",
    "split_corrupt", "split_sections", "write_bad_records",
]
