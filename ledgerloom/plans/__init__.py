"""Business models: identity, ledgers, usage, support, health, finance and activation marts."""
