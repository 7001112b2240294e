"""Writers for survivors, metrics, patterns and shards."""
