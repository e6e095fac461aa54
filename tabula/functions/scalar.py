"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word characters as Python's ``\w`` sees them (letters, digits, underscore),
# written as Unicode classes that Java and RE2 both read the same way.
WORD = r"[\p{L}\p{N}_]+"
# Two or more word characters: the default token rule of the TF-IDF vectoriser.
WORD2 = r"[\p{L}\p{N}_]{2,}"

FLOATING = (T.FloatType, T.DoubleType)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, FLOATING)


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for floating columns: pandas treats both as missing."""
    c = F.col(name)
    if is_floating(df, name):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return F.nanvl(c, F.lit(None).cast("double")) if is_floating(df, name) else c


def tokens(text, pattern: str = WORD) -> Column:
    """``tokens_regex``: every match of ``pattern``, case kept, in order."""
    return F.regexp_extract_all(col_of(text), F.lit(pattern), 0)


def lower_tokens(arr) -> Column:
    return F.transform(col_of(arr), lambda t: F.lower(t))


def one_hot_array(label, k: int) -> Column:
    """``one_hot_array``: 0/1 int array of length k with a 1 at ``label``."""
    lab = col_of(label)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == lab).cast("int"))


def rescale_array(arr, center: float = 0.0, scale: float = 255.0) -> Column:
    """``rescale_array``: ``(x - center) / scale`` element-wise."""
    return F.transform(col_of(arr), lambda x: (x.cast("double") - F.lit(center)) / F.lit(scale))


def argmax_array(arr) -> Column:
    """``argmax_array``: 0-based position of the largest element, first on ties."""
    a = col_of(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def label_map(c, mapping: dict) -> Column:
    """``label_map_lookup``: dictionary lookup; unknown codes give NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), col_of(c))


def threshold_flag(c, t: float) -> Column:
    """``threshold_flag``: 1 when strictly above ``t``, else 0 (NULL stays NULL)."""
    return (col_of(c) > F.lit(t)).cast("int")


def safe_corr(a, b) -> Column:
    """Pearson correlation that is NULL (not a division error under ANSI
    mode) when either column is constant."""
    a, b = col_of(a).cast("double"), col_of(b).cast("double")
    # pairwise complete rows only, like corr()
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))
