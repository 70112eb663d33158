"""Plan shapes shared by the operators, and the chains built from them."""
