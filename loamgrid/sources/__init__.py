"""Table contracts, scans, the release manifest and the pixel table."""
