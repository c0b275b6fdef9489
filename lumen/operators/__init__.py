"""Multi-step DataFrame operators."""
