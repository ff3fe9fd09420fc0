"""Writers. Each takes a batch or a streaming DataFrame."""
