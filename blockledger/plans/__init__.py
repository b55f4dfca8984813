"""blockledger.plans."""
