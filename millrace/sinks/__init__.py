"""Writers: numbered commits, events tables, materialized tables, progress."""
