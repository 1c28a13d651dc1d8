"""Row rules, dedupe, resampling, series indexing and feature windows."""
