"""End-to-end flows and their partition plans."""
