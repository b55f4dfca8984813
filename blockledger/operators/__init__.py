"""blockledger.operators."""
