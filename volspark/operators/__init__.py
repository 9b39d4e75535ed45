"""DataFrame-in, DataFrame-out operators over quotes, curves, dividends, surfaces and contracts."""
