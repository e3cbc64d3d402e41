"""Column expressions: cosine, node text, display names, tokens, hashing."""

from .columns import (SEPARATORS, NODE_TEXT_SEP, SCORE_DECIMALS, WORD_TOKEN, cosine,
                      id_tokens, display_name, dot, md5_bucket, node_text, norm,
                      round_score, strip_prefix, word_tokens)

__all__ = ["SEPARATORS", "NODE_TEXT_SEP", "SCORE_DECIMALS", "WORD_TOKEN", "cosine",
           "id_tokens", "display_name", "dot", "md5_bucket", "node_text", "norm",
           "round_score", "strip_prefix", "word_tokens"]
