"""Landing, raw loading and source contracts."""
