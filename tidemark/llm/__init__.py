"""Operations of a training-data pipeline: dedup, filtering, mixing, tokenising.

Nothing outside this folder imports it. Each ``*_op`` module holds one
operator with its own interface; ``queries`` derives the registered queries.
"""
