"""Table operators: range planning, ordered scans, packing, line chunks."""
