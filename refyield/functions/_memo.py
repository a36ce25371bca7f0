"""Reuse built Column expressions.

Building a Column costs Py4J round trips (about a millisecond each), and the
report's expressions take a few hundred of them. The expressions only
refer to columns by name, so one built Column can serve every DataFrame;
we keep them per SparkContext (as long as it lives) and per argument tuple.
Calls with non-hashable arguments (Column objects) are simply not cached.
"""

from __future__ import annotations

import functools
import weakref

from pyspark import SparkContext

_SIMPLE = (str, int, float, bool, type(None))


def _hashable(v) -> bool:
    if isinstance(v, _SIMPLE):
        return True
    if isinstance(v, tuple):
        return all(_hashable(x) for x in v)
    return False


def memo_columns(fn):
    caches: weakref.WeakKeyDictionary[SparkContext, dict] = weakref.WeakKeyDictionary()

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        if not (all(_hashable(a) for a in args) and all(_hashable(v) for v in kwargs.values())):
            return fn(*args, **kwargs)
        context = SparkContext._active_spark_context
        if context is None:
            return fn(*args, **kwargs)
        cache = caches.setdefault(context, {})
        key = (args, tuple(sorted(kwargs.items())))
        hit = cache.get(key)
        if hit is None:
            hit = cache[key] = fn(*args, **kwargs)
        return hit

    return wrapper
