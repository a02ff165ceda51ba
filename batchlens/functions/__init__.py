"""Column functions: prompt templates and nested speech columns."""
