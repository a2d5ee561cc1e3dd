"""Pure DataFrame → DataFrame operators; no operator here reads or writes storage."""
