"""DataFrame operators: envelope, transactions, fold, apply, merge-on-read, evolution, replay, checks, metrics."""
