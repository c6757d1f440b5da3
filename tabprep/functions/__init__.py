"""Column-expression helpers: quoting, deterministic hashing, exact ranks."""
