"""Table writes: managed saves, evolving schemas, upserts and views."""
