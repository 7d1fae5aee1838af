"""DataFrame operators of the snapshot plan: quotes, trades, merge and fill."""
