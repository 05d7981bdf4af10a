"""Passes that ask a judge outside the engine: requests are packed, replies checked, verdicts kept in a ledger and applied by joins."""
