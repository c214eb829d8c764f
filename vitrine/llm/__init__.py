"""Operators for building training corpora.

One module per operator; ``queries`` registers them over the given tables. Nothing outside this
package imports it.
"""
