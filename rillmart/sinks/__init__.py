"""Writers: topics, dimension tables, stats tables."""
