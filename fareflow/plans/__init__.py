"""The fare jobs: one function per derived table."""
