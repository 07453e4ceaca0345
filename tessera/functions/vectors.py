"""Vector arithmetic as column expressions (F18-F23) and long-form joins.

Two row-wise representations:

* dense  - ``array<double>``
* sparse - ``struct<size:int, indices:array<int>, values:array<double>>``
  (the same three fields as an ML ``SparseVector``), built by :func:`sparse`.

Row-wise products use higher-order functions (``aggregate``/``zip_with``),
which run inside whole-stage code generation.  For one vector against a whole
table, the scalable form is *long* - one row per non-zero entry - and the
product is an equi-join on the index followed by a grouped sum
(:func:`long_dot`); that is how the similarity plans use it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


# --- constructors -------------------------------------------------------------

def sparse(size, indices, values) -> Column:
    """Sparse vector struct from a size and parallel index/value arrays."""
    return F.struct(
        _c(size).cast("int").alias("size"),
        _c(indices).cast("array<int>").alias("indices"),
        _c(values).cast("array<double>").alias("values"),
    )


def dense(arr) -> Column:
    return _c(arr).cast("array<double>")


def _size_mismatch(a_size: Column, b_size: Column) -> Column:
    return F.raise_error(
        F.concat(
            F.lit("vector sizes differ: "), a_size.cast("string"), F.lit(" vs "), b_size.cast("string")
        )
    )


# --- dense (F19) ---------------------------------------------------------------

def dense_dot(a, b) -> Column:
    """dense . dense; unequal sizes raise."""
    a, b = _c(a), _c(b)
    prod = _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    return F.when(F.size(a) != F.size(b), _size_mismatch(F.size(a), F.size(b))).otherwise(prod)


def dense_norm(a) -> Column:
    """Euclidean norm of a dense vector."""
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def _divide_each(arr: Column, n: Column) -> Column:
    """Divide every element by ``n``, evaluating ``n`` once per row.

    An expression inside a lambda is re-evaluated for every element, so the
    norm is first spread into an array and zipped in (O(d), not O(d^2)).
    """
    return F.zip_with(arr, F.array_repeat(n, F.size(arr)), lambda x, m: x.cast("double") / m)


def dense_normalize(a) -> Column:
    """divide by the L2 norm; a zero vector is returned unchanged."""
    a = _c(a)
    n = dense_norm(a)
    return F.when(n == 0, dense(a)).otherwise(_divide_each(a, n))


def dense_cosine(a, b) -> Column:
    """cosine of two dense vectors, ``a.b / (|a| |b|)``; 0 when either is zero.

    Equal to the dot of the normalised vectors (the reference's form) up to
    rounding in the last place, in O(d).
    """
    a, b = _c(a), _c(b)
    na, nb = dense_norm(a), dense_norm(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dense_dot(a, b) / (na * nb))


# --- sparse (F20, F21) ------------------------------------------------------------

def sparse_norm(v) -> Column:
    v = _c(v)
    return F.sqrt(_sum(F.transform(v["values"], lambda x: x * x)))


def sparse_normalize(v) -> Column:
    """F18 for sparse vectors; zero vector unchanged."""
    v = _c(v)
    n = sparse_norm(v)
    scaled = F.when(n == 0, v["values"]).otherwise(_divide_each(v["values"], n))
    return sparse(v["size"], v["indices"], scaled)


def sparse_dense_dot(s, d) -> Column:
    """sparse . dense (and, with arguments swapped, dense . sparse)."""
    s, d = _c(s), _c(d)
    entries = F.arrays_zip(s["indices"].alias("i"), s["values"].alias("v"))
    prod = F.aggregate(
        entries,
        F.lit(0.0).cast("double"),
        lambda acc, e: acc + e["v"] * F.element_at(d, e["i"] + 1).cast("double"),
    )
    return F.when(s["size"] != F.size(d), _size_mismatch(s["size"], F.size(d))).otherwise(prod)


def sparse_dot(a, b) -> Column:
    """sparse . sparse over the indices present in both; unequal sizes raise."""
    a, b = _c(a), _c(b)
    # both maps are built once per row; map_zip_with merges their keys
    # (O(nnz_a + nnz_b)) and indices present on one side only contribute 0
    merged = F.map_zip_with(
        F.map_from_arrays(a["indices"], a["values"]),
        F.map_from_arrays(b["indices"], b["values"]),
        lambda k, x, y: F.coalesce(x * y, F.lit(0.0)),
    )
    prod = _sum(F.map_values(merged))
    return F.when(a["size"] != b["size"], _size_mismatch(a["size"], b["size"])).otherwise(prod)


# --- dispatch (F22) ----------------------------------------------------------------

def _kind(dt: T.DataType) -> str:
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.NumericType):
        return "dense"
    if isinstance(dt, T.StructType) and {"size", "indices", "values"} <= set(dt.fieldNames()):
        return "sparse"
    raise TypeError(f"not a vector column type: {dt.simpleString()}")


def dot(df: DataFrame, a: str, b: str) -> Column:
    """pick the product by the two columns' types in ``df``.

    dense.dense, sparse.dense, dense.sparse and sparse.sparse are supported;
    any other type raises ``TypeError`` and unequal sizes raise at run time.
    """
    ka, kb = _kind(df.schema[a].dataType), _kind(df.schema[b].dataType)
    if ka == "dense" and kb == "dense":
        return dense_dot(a, b)
    if ka == "sparse" and kb == "dense":
        return sparse_dense_dot(a, b)
    if ka == "dense" and kb == "sparse":
        return sparse_dense_dot(b, a)
    return sparse_dot(a, b)


# --- long form ------------------------------------------------------------------------

def long_dot(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    index: str = "index",
    value: str = "value",
    out: str = "dot",
    how: str = "inner",
) -> DataFrame:
    """Dot products of every long-form ``left`` vector with the one vector ``right``.

    ``left`` holds one row per non-zero entry, ``(*keys, index, value)``;
    ``right`` one row per index.  With ``how="inner"`` only vectors sharing an
    index appear; with ``how="left"`` every left vector does, 0.0 when nothing
    is shared - one join and one aggregate, no separate key list.  The join
    has no size hint: when the right side is small (a query vector) Spark's
    size check broadcasts it, otherwise it is a shuffle join whose skewed
    partitions AQE splits.  The sum is partially aggregated before its shuffle.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    lk = [F.col(f"l.{k}").alias(k) for k in left_keys]
    joined = left.alias("l").join(right.alias("r"), F.col(f"l.{index}") == F.col(f"r.{index}"), how)
    prod = F.coalesce(F.col(f"l.{value}").cast("double") * F.col(f"r.{value}").cast("double"), F.lit(0.0))
    return joined.select(*lk, prod.alias("_p")).groupBy(*left_keys).agg(F.sum("_p").alias(out))
