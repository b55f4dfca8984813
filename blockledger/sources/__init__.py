"""blockledger.sources."""
