"""Vector expressions on ``array<float|double>`` columns (JVM side, no Python).

Spark 4.1 has no built-in vector dot product or cosine; these are higher-order
function compositions, evaluated per row inside the executor JVM.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound on a vector norm when normalising; matches the usual
# ``x / max(||x||, eps)`` convention of sentence encoders.
NORM_EPS = 1e-12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_of_squares(v: Column | str) -> Column:
    return F.aggregate(_col(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(sum_of_squares(v))


def divide_by(v: Column | str, d: Column) -> Column:
    """Element-wise ``v / d`` with ``d`` evaluated once per row.

    ``d`` enters as an ``array_repeat`` argument rather than inside the
    lambda, where it would be re-evaluated for every element."""
    v = _col(v)
    return F.zip_with(v, F.array_repeat(d, F.size(v)), lambda x, n: x.cast("double") / n)


def l2_normalize(v: Column | str) -> Column:
    """``x / max(||x||, 1e-12)`` element-wise, as ``array<double>``."""
    v = _col(v)
    return divide_by(v, F.greatest(l2_norm(v), F.lit(NORM_EPS)))


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two equal-length arrays, in double."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def literal_vector(values: Sequence[float]) -> Column:
    """A bounded vector as a literal ``array<double>``."""
    return F.array(*[F.lit(float(x)).cast("double") for x in values])


def literal_matrix(rows: Sequence[Sequence[float]]) -> Column:
    """A bounded matrix as one literal ``array<array<double>>`` (row major).

    Passed as a JSON string that constant folding turns into a single array
    literal: a tree of one literal per element would make every optimizer
    pass and the generated code scale with ``m x d``."""
    text = json.dumps([[float(x) for x in r] for r in rows])
    return F.from_json(F.lit(text), "array<array<double>>")
