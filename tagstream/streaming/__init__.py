"""Structured Streaming helpers: bounded runs, stateful folds, dedupe."""
