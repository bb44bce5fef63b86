"""Writers: raw payloads, day-partitioned layers, the versioned serving table."""
