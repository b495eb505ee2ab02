"""URL resolution (P3) as a built-in CASE expression.

Covers the forms met on listing pages: absolute (has a scheme),
scheme-relative (``//host/..``), root-relative (``/path``), query-only
(``?..``), fragment-only (``#..``), empty, and relative paths merged with
the base directory. Dot segments are removed at any depth from relative and
root-relative paths.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
ORIGIN_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
SCHEME_ONLY_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
NO_QUERY_RE = r"^([^?#]*)"
NO_FRAGMENT_RE = r"^([^#]*)"
REST_RE = r"([?#].*)$"
DIR_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(?:[^?#]*/)?)"


def _resolved_path(path: Column) -> Column:
    """``.`` and ``..`` segments taken out of an absolute path in one fold
    over its segments, at any depth; ``..`` at the root stays at the root, and a
    path that ends in one of them ends in a slash."""
    segments = F.split(path, "/")

    def step(done, segment):
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(segment == "..", shorter).when(segment == ".", done).otherwise(F.array_append(done, segment))

    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    folded = F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    joined = F.array_join(folded, "/")
    joined = F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))
    return F.when(path.rlike(r"/\.\.?(/|$)"), joined).otherwise(path)


def resolve_url(base, href) -> Column:
    b, h = col_(base), col_(href)
    origin = F.regexp_extract(b, ORIGIN_RE, 1)
    scheme = F.regexp_extract(b, SCHEME_ONLY_RE, 1)
    base_dir = F.regexp_extract(b, DIR_RE, 1)
    base_dir = F.when(base_dir.endswith("/"), base_dir).otherwise(F.concat(base_dir, F.lit("/")))
    folder = F.substring(base_dir, F.length(origin) + 1, F.length(base_dir))
    path, rest = F.regexp_extract(h, NO_QUERY_RE, 1), F.regexp_extract(h, REST_RE, 1)
    # empty segments inside a merged path are dropped, those of a root-relative one stay
    merged = F.regexp_replace(F.concat(folder, path), "/{2,}", "/")
    return (F.when(h.rlike(SCHEME_RE), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("/"), F.concat(origin, _resolved_path(path), rest))
            .when(h.startswith("?"), F.concat(F.regexp_extract(b, NO_QUERY_RE, 1), h))
            .when(h.startswith("#"), F.concat(F.regexp_extract(b, NO_FRAGMENT_RE, 1), h))
            .when(h == "", F.regexp_extract(b, NO_FRAGMENT_RE, 1))
            .otherwise(F.concat(origin, _resolved_path(merged), rest)))
