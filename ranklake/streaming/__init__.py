"""The incremental rules as Structured Streaming over arriving files."""
