"""Column functions over vectors, and the two functions of pixels that need numpy."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalized(v: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    n = norm(v)
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def or_zero(v: Column, dim: int) -> Column:
    return F.coalesce(v, zero_vector(dim))


def changed_share(a: Column, b: Column, delta: float = 30.0) -> Column:
    """Share of places at which two equally long arrays differ by more than ``delta``; 0 for empty ones."""
    n = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")) > delta), F.lit(0), lambda s, x: s + x.cast("int"))
    return F.coalesce(F.try_divide(n.cast("double"), F.size(a)), F.lit(0.0))


def changed(a: Column, b: Column, delta: float = 30.0, share: float = 0.15) -> Column:
    return changed_share(a, b, delta) >= F.lit(share)


@F.pandas_udf(T.DoubleType())
def blur_score(pixels: pd.Series, width: pd.Series) -> pd.Series:
    """Variance of the Laplacian of a gray image, given as bytes row by row; borders are mirrored."""
    import numpy as np

    def one(data, w):
        if data is None or not w or len(data) < w:
            return 0.0
        g = np.frombuffer(data, dtype=np.uint8)[: len(data) // w * w].reshape(-1, w).astype(float)
        p = np.pad(g, 1, mode="reflect" if min(g.shape) > 1 else "edge")
        return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var())

    return pd.Series([one(d, int(w or 0)) for d, w in zip(pixels, width)])


def hash_embedding(dim: int):
    """A deterministic stand-in for a text model: hashed tokens, unit length. Null is embedded as ''. A token's first 32
    bits of MD5 choose its place, and the highest of them its sign. A worker holds a slice of the texts, and of the vectors,
    as Python's objects; the rest of a batch stays as Arrow has it."""

    import pyarrow as pa

    def embed(texts):
        import hashlib

        import numpy as np

        from ..session import slices

        out = [pa.array([], pa.list_(pa.float32()))]
        for part in slices([pa.RecordBatch.from_arrays([texts], ["t"])], "t"):
            m = np.zeros((part.num_rows, dim))
            for v, t in zip(m, part.column("t").to_pylist()):
                for w in (t or "").lower().split():
                    h = int(hashlib.md5(w.encode("utf-8", "replace")).hexdigest()[:8], 16)
                    v[h % dim] += 1 if h >> 31 else -1
                n = np.linalg.norm(v)
                v /= n or 1.0
            out.append(pa.ListArray.from_arrays(np.arange(part.num_rows + 1, dtype=np.int32) * dim, m.astype(np.float32).ravel()))
        return pa.concat_arrays(out)

    embed.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(embed, T.ArrayType(T.FloatType()))
