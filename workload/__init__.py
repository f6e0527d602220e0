"""The operators applied to the shared test tables, with equivalent SQL."""
