"""Table writes, staging and the resume ledger."""
