"""File sources: listing, line and delimited scans, templated paths."""
