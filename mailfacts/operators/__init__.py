"""DataFrame operators the plans are composed from."""
