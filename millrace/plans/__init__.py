"""The registered queries: inputs, Spark plans, SQL oracles."""
