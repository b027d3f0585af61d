"""Document sources and index storage."""
