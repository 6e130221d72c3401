"""Landing, staging, seeds, catalogs and table sinks."""
