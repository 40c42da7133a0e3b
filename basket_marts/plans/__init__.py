"""The jobs: cleaning, marts, quality gate, read-side queries, benchmark, whole batch."""
