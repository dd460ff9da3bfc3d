"""Column functions (native Catalyst expressions unless a module says otherwise)."""
