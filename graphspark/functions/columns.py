"""Column-level functions (JVM-side expressions, whole-stage codegen friendly).

Fixed values (must equal the original behaviour):
  node text separator          ". "
  synonym bracket              "["
  list separators in a column  see SEPARATORS
  score rounding               6 decimals, before ranking and cutoff tests
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NODE_TEXT_SEP = ". "
# A word of any script: letters with their marks, and digits, over lower-cased text (the built-in encoder's choice).
WORD_TOKEN = "[\\p{L}\\p{M}\\p{N}]+"
# What separates ids inside one column (lists, quoted or bracketed values).
# An id is a maximal run without these, so `part:1` does not match `part:10`
# and an id keeps its dots and dashes.
SEPARATORS = "[\\s|,;'\"\\[\\](){}]+"
SCORE_DECIMALS = 6


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Dot product of two numeric arrays, accumulated in DOUBLE."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda s, v: s + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity of two arrays; NULL when either vector has zero norm.

    (A zero vector has no direction. The original engine yields NaN there;
    here it is NULL so that it never ranks.)
    """
    na, nb = norm(a), norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


def round_score(x) -> Column:
    return F.round(_c(x), SCORE_DECIMALS)


def node_text(name="name", synonym="synonym", description="description") -> Column:
    """O7 text: name, synonym and description joined by '. ', NULLs skipped.

    An empty string is not skipped (concat_ws skips only NULL), and a node
    whose three fields are all NULL gets ''.
    """
    return F.concat_ws(NODE_TEXT_SEP, _c(name), _c(synonym), _c(description))


def display_name(text="text") -> Column:
    """The part of a node text before the first '[', whitespace-stripped,
    trailing dots removed. A text without '[' yields the whole text."""
    head = F.substring_index(_c(text), "[", 1)
    stripped = F.regexp_replace(head, r"^\s+|\s+$", "")
    return F.regexp_replace(stripped, r"\.+$", "")


def strip_prefix(x, prefix: str) -> Column:
    """Remove a literal prefix (e.g. 'biolink:') where present."""
    col = _c(x)
    if not prefix:
        return col
    return F.when(col.startswith(prefix), F.substring(col, len(prefix) + 1, 1 << 30)).otherwise(col)


def id_tokens(cols) -> Column:
    """Distinct ids that a row mentions: each whole column value, and each run
    without a list separator in it."""
    values = F.array(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])
    return F.array_distinct(F.concat(values, F.split(F.array_join(values, "\t"), SEPARATORS)))


def word_tokens(x) -> Column:
    return F.regexp_extract_all(F.lower(_c(x)), F.lit(WORD_TOKEN), 0)


def md5_bucket(token, dim: int) -> Column:
    """Feature-hashing bucket of a token: first 60 bits of md5, modulo dim."""
    h = F.conv(F.substring(F.md5(_c(token)), 1, 15), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(dim)).cast("int")
