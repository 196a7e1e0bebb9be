"""The card-transaction flows, and the registered queries over the given tables."""
