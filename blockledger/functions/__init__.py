"""blockledger.functions."""
