"""Operators for preparing language-model training text.

Each module holds one operator; ``queries`` registers them by number. Nothing outside this
package imports it.
"""
