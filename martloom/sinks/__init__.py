"""Writers: CSV results, view extracts, JSON summary."""
