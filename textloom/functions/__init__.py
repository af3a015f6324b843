"""Column expressions; none of them triggers a job or a shuffle."""
