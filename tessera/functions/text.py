"""Tokenisation and sequence helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns.
# Word-punct: runs of word characters, or runs of characters that are neither word nor space.
WORDPUNCT_PATTERN = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+)"
# Tweet-style: URLs, @handles, #tags, common emoticons, words with inner apostrophes, numbers, other symbols.
TWEET_PATTERN = (
    r"(https?://\S+|www\.\S+|@\w+|#\w+|[:;=8][\-o\*']?[\)\]\(\[dDpP/\\:\}\{@\|]"
    r"|[\p{L}\p{N}_]+(?:['’][\p{L}\p{N}_]+)*|\.\.\.|[^\p{L}\p{N}_\s])"
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wordpunct_tokens(col, lower: bool = True) -> Column:
    """Array of word-punct tokens of ``col`` (lower-cased by default)."""
    c = _c(col)
    if lower:
        c = F.lower(c)
    return F.regexp_extract_all(c, F.lit(WORDPUNCT_PATTERN), 1)


def wordpunct(col, lower: bool = True) -> Column:
    """Word-punct tokens joined by single spaces (the reference's line form)."""
    return F.array_join(wordpunct_tokens(col, lower), " ")


def tweet_tokens(col, lower: bool = True) -> Column:
    """Tweet-style tokens: keeps URLs, handles, hashtags and emoticons whole."""
    c = _c(col)
    if lower:
        c = F.lower(c)
    return F.regexp_extract_all(c, F.lit(TWEET_PATTERN), 1)


def assemble_line(title, summary=None, sep: str = " ; ", max_len: int | None = 512,
                  bos: str | None = None, eos: str | None = None) -> Column:
    """``title + sep + summary``, newlines to spaces, truncated, optional BOS/EOS wrap."""
    c = _c(title) if summary is None else F.concat(_c(title), F.lit(sep), _c(summary))
    c = F.regexp_replace(c, r"\n", " ")
    if max_len is not None:
        c = F.substring(c, 1, max_len)
    if bos is not None:
        c = F.concat(F.lit(bos + " "), c)
    if eos is not None:
        c = F.concat(c, F.lit(" " + eos))
    return c


def pad_ids(arr, max_len: int, pad=0, side: str = "right", truncate: str = "right") -> Column:
    """Pad or truncate an array to exactly ``max_len`` elements."""
    a = _c(arr)
    if truncate == "right":
        cut = F.slice(a, 1, max_len)
    else:
        cut = F.when(F.size(a) > max_len, F.slice(a, F.size(a) - max_len + 1, max_len)).otherwise(a)
    fill = F.array_repeat(F.lit(pad), F.greatest(F.lit(max_len) - F.size(cut), F.lit(0)))
    return F.concat(cut, fill) if side == "right" else F.concat(fill, cut)


def word_dropout(arr, p: float, seed: int, key, unk, pad) -> Column:
    """Replace each element by ``unk`` with probability ``p``; ``pad`` is never replaced.

    The draw is ``xxhash64(seed, key, position)`` so a retried task or a
    different partitioning makes the same choice (unlike ``rand``).
    """
    k = _c(key)
    threshold = int(p * 1_000_000)
    return F.transform(
        _c(arr),
        lambda x, i: F.when(
            (x != F.lit(pad)) & (F.pmod(F.xxhash64(F.lit(seed), k, i), F.lit(1_000_000)) < threshold),
            F.lit(unk),
        ).otherwise(x),
    )
