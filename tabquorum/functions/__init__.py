from .bands import band, zero_flag
from .hashing import hash_bucket, hash_word, member_uniform, poisson_count
from .scores import argmax_index, softmax, vote_scores
from .text import honorific, honorific_by_split, lookup, text_shape

__all__ = ["band", "zero_flag", "hash_bucket", "hash_word", "member_uniform", "poisson_count",
           "argmax_index", "softmax", "vote_scores", "honorific", "honorific_by_split", "lookup",
           "text_shape"]
