"""Datasets behind the executive, risk, equipment, quality and scorecard reports."""
