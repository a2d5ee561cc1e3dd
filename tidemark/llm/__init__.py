"""Operators that prepare documents for language-model training, and their registered queries."""
