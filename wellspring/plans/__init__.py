"""End-to-end survey jobs (W1-W11), each a composition of DataFrame operators."""
