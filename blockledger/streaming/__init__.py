"""blockledger.streaming."""
