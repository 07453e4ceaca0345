"""End-to-end plans: transaction reports, content similarity, recommendation."""
