"""Source trees: listing, filtering, reading and scanning."""
