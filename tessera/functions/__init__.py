"""Column -> Column helpers (all JVM-side expressions unless stated)."""

from tessera.functions.dates import epoch_micros, epoch_seconds
from tessera.functions.text import (
    assemble_line,
    pad_ids,
    tweet_tokens,
    word_dropout,
    wordpunct,
    wordpunct_tokens,
)
from tessera.functions.units import to_litres
from tessera.functions.vectors import (
    cosine_similarity,
    dot,
    l2_distance,
    l2_norm,
    sharpen,
    softmax,
    vec_add,
    vec_scale,
)

__all__ = [
    "assemble_line", "cosine_similarity", "dot", "epoch_micros", "epoch_seconds", "l2_distance",
    "l2_norm", "pad_ids", "sharpen", "softmax", "to_litres", "tweet_tokens", "vec_add", "vec_scale",
    "word_dropout", "wordpunct", "wordpunct_tokens",
]
