"""End-to-end flows composed from the operators, and the query registry."""
