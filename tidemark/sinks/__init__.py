"""Writers: CSV, named CSV, messages."""
