"""Reuse of built column expressions.

A Column tree is an immutable, unresolved expression; building a deep one
(the key-point walk) costs hundreds of calls into the JVM.  Builders whose
input is a column *name* and whose settings are hashable are memoized per
JVM gateway, so a plan built twice pays that cost once.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping


def _freeze(v):
    if isinstance(v, (list, tuple)):
        return tuple(_freeze(x) for x in v)
    if isinstance(v, Mapping):
        return tuple(sorted((k, _freeze(x)) for k, x in v.items()))
    hash(v)
    return v


def _gateway_id():
    try:
        from pyspark import SparkContext
        return id(SparkContext._gateway)
    except Exception:  # noqa: BLE001
        return None


def by_column_name(fn: Callable) -> Callable:
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(c, *args, **kwargs):
        if not isinstance(c, str):
            return fn(c, *args, **kwargs)
        try:
            key = (_gateway_id(), c, _freeze(args), _freeze(kwargs))
        except TypeError:
            return fn(c, *args, **kwargs)
        col = cache.get(key)
        if col is None:
            col = cache[key] = fn(c, *args, **kwargs)
        return col

    return wrapper
