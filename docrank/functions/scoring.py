"""tf-idf and cosine arithmetic as Column expressions.

w(t, d) = (1 + ln tf) * ln(N / df);  |d| = sqrt(sum w^2);
sim = sum(qw * w) / (|q| * |d|), and 0.0 when the denominator is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tf_weight(count) -> Column:
    """1 + ln(count)."""
    return F.lit(1.0) + F.log(_c(count).cast("double"))


def idf(n_docs, df) -> Column:
    """ln(N / df), natural log, no smoothing (df = N gives 0)."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return F.log(n.cast("double") / _c(df).cast("double"))


def tfidf(count, idf_col) -> Column:
    return tf_weight(count) * _c(idf_col)


def safe_ratio(num, den) -> Column:
    """num / den, 0.0 where den is 0 (ANSI division would raise)."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))
