"""DataFrame -> DataFrame operators: contract, conform, enrich, marts, ledger."""
