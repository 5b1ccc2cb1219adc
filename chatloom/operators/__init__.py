"""DataFrame operators: checks, naming, membership, threads, rendering, resume, monitoring."""
