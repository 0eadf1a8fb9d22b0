"""URL and filename expressions: split, normalise, fingerprint, resolve, type tests.

All of it is built-in string and array functions, so it stays inside the JVM and
runs in the scan stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions.text import any_of, contains_any, filled, first_containing, let

_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def scheme_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 1))


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def raw_path_of(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 3)


def path_of(url: Column) -> Column:
    """Path without the ``;params`` of its last segment."""
    p = raw_path_of(url)
    return F.when(p.contains(";"), F.regexp_replace(p, r";[^/]*$", "")).otherwise(p)


def query_of(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 4)


def percent_decode(text: Column) -> Column:
    """Form decoding; a ``%`` that starts no valid escape stays as it is."""
    safe = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(text.rlike(r"[%+]"), F.try_url_decode(safe)).otherwise(text)


def _all_pairs(query: Column) -> Column:
    kept = F.filter(F.split(query, "&"), lambda p: p.rlike(r"^[^=]*=."))
    return F.transform(
        kept,
        lambda p: F.struct(
            percent_decode(F.regexp_extract(p, r"(?s)^([^=]*)=(.*)$", 1)).alias("k"),
            percent_decode(F.regexp_extract(p, r"(?s)^([^=]*)=(.*)$", 2)).alias("v"),
        ),
    )


def query_pairs(query: Column) -> Column:
    """Ordered array of (k, v): decoded, blank values dropped, only the first value of a key kept."""
    return F.aggregate(
        _all_pairs(query),
        F.expr("CAST(array() AS array<struct<k:string,v:string>>)"),
        lambda acc, p: F.when(F.exists(acc, lambda a: a["k"] == p["k"]), acc).otherwise(F.concat(acc, F.array(p))),
    )


def query_map(url: Column) -> Column:
    """Query as map key -> array of values, repeated keys keep every value in order."""
    return let(
        _all_pairs(query_of(url)),
        lambda pairs: F.map_from_entries(
            F.transform(
                F.array_distinct(F.transform(pairs, lambda p: p["k"])),
                lambda k: F.struct(
                    k.alias("key"),
                    F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]).alias("value"),
                ),
            )
        ),
    )


def sorted_query(query: Column, drop: Sequence[str]) -> Column:
    pairs = F.filter(query_pairs(query), lambda p: ~F.lower(p["k"]).isin(list(drop)))
    text = F.array_join(
        F.transform(F.array_sort(pairs), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&"
    )
    return F.when(query.contains("="), text).otherwise(F.lit(""))


def fold_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; climbing above the root stops at the root."""
    segs = F.split(path, "/")
    last_is_dots = F.element_at(segs, -1).isin(".", "..")
    kept = F.aggregate(
        segs,
        F.expr("CAST(array() AS array<string>)"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    joined = F.array_join(F.when(last_is_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def _unescape_unreserved(path: Column) -> Column:
    """``%41`` -> ``A`` for letters, digits and ``-._~``; other escapes stay."""
    parts = F.regexp_extract_all(path, F.lit(r"(%[0-9A-Fa-f]{2}|[^%]+|%)"), F.lit(1))
    plain = F.array_join(
        F.transform(
            parts,
            lambda p: F.when(
                p.rlike(r"^%(4[1-9A-Fa-f]|5[0-9Aa]|6[1-9A-Fa-f]|7[0-9Aa]|3[0-9]|2[DdEe]|5[Ff]|7[Ee])$"),
                F.char(F.conv(F.substring(p, 2, 2), 16, 10).cast("bigint")),
            ).otherwise(p),
        ),
        "",
    )
    return F.when(path.contains("%"), plain).otherwise(path)


def normalize_url(url: Column, profile: str = "standard", lower_path: bool = False) -> Column:
    """Canonical URL for dedup.

    ``standard`` drops volatile query keys and the fragment, sorts the rest.
    ``extended`` also lower-cases the host, drops tracking keys, the default
    port, doubled and trailing slashes, resolves dot segments and needless
    percent escapes; ``lower_path`` lower-cases the path on top of that.
    """
    scheme, host, path, query = scheme_of(url), host_of(url), path_of(url), query_of(url)
    drop = list(R.VOLATILE_PARAMS)
    if profile == "extended":
        drop += R.TRACKING_PARAMS
        host = F.lower(host)
        host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(
            scheme == "https", F.regexp_replace(host, ":443$", "")
        ).otherwise(host)
        path = _unescape_unreserved(path)
        path = fold_dots(F.regexp_replace(path, "/{2,}", "/"))
        path = F.regexp_replace(path, "/+$", "")
        if lower_path:
            path = F.lower(path)
    elif profile != "standard":
        raise ValueError(f"unknown profile {profile!r}")
    q = sorted_query(query, drop)
    base = F.concat(scheme, F.lit("://"), host, path)
    return F.when(q != "", F.concat(base, F.lit("?"), q)).otherwise(base)


def url_fingerprint(url: Column, profile: str = "standard", lower_path: bool = False) -> Column:
    return F.sha2(normalize_url(url, profile, lower_path), 256)


def filename_from_url(url: Column) -> Column:
    name = F.element_at(F.split(F.regexp_replace(path_of(url), "/+$", ""), "/"), -1)
    return F.when(name.contains("."), name)


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(?s)^.+\.([^.]+)$", 1))


def file_type(url: Column, content_type: Column | None = None) -> Column:
    ext = extension(filename_from_url(url))
    by_ext = F.when(ext.isin(R.DOCUMENT_EXTENSIONS), ext)
    if content_type is None:
        return by_ext
    return F.coalesce(by_ext, first_containing(F.lower(content_type), R.CONTENT_TYPE_RULES))


def path_segments(url: Column) -> Column:
    """Lower-cased non-empty path segments."""
    return F.filter(F.split(F.lower(path_of(url)), "/"), lambda s: s != "")


def file_stem(name: Column) -> Column:
    base = F.element_at(F.split(F.regexp_replace(name, "/+$", ""), "/"), -1)
    return F.regexp_replace(base, r"(?s)^(.+)\.[^.]+$", "$1")


def stem_tokens(name: Column) -> Column:
    return F.split(F.lower(file_stem(name)), r"[_\-\s.]+")


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` seen on page ``base``."""
    scheme, host = scheme_of(base), host_of(base)
    base_path, base_query = raw_path_of(base), query_of(base)
    root = F.concat(scheme, F.lit("://"), host)
    h_path = F.regexp_extract(href, r"(?s)^([^?#]*)", 1)
    h_rest = F.regexp_extract(href, r"(?s)^[^?#]*(.*)$", 1)
    with_query = F.when(base_query != "", F.concat(root, base_path, F.lit("?"), base_query)).otherwise(
        F.concat(root, base_path)
    )
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    merged = F.regexp_replace(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), h_path), r"/{2,}(?!$)", "/"
    )
    folded_root = fold_dots(h_path)
    folded_rel = fold_dots(merged)

    def rooted(p):
        return F.when(p == "", F.lit("/")).when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p))

    return (
        F.when(href.isNull() | (href == ""), base)
        .when(href.rlike(_ABSOLUTE), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(with_query, href))
        .when(href.startswith("?"), F.concat(root, base_path, href))
        .when(href.startswith("/"), F.concat(root, rooted(folded_root), h_rest))
        .otherwise(F.concat(root, rooted(folded_rel), h_rest))
    )


def is_document_url(url: Column, file_types: Column | Sequence[str] | None = None,
                    words: str = R.DOCUMENT_URL_WORDS) -> Column:
    """Extension test on the path, or a document word in a URL that is no navigation link."""
    path = F.lower(path_of(url))
    if file_types is None:
        file_types = R.DEFAULT_LINK_TYPES
    if isinstance(file_types, Column):
        by_ext = F.exists(file_types, lambda t: F.endswith(path, F.concat(F.lit("."), t)))
    else:
        by_ext = any_of([path.endswith("." + t) for t in file_types])
    low = F.lower(url)
    by_word = low.rlike(words) & ~contains_any(low, R.NAVIGATION_MARKS)
    return by_ext | by_word


def glob_regex(pattern: str) -> str:
    return "(?i)" + pattern.replace("*", ".*").replace("?", ".")


def matches_glob(url: Column, patterns: Column | Sequence[str]) -> Column:
    """``*`` and ``?`` globs searched anywhere; other regex signs keep their regex meaning."""
    if isinstance(patterns, Column):
        return F.coalesce(
            F.exists(
                patterns,
                lambda p: F.regexp_like(
                    url, F.concat(F.lit("(?i)"), F.replace(F.replace(p, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")))
                ),
            ),
            F.lit(False),
        )
    if not patterns:
        return F.lit(False)
    return any_of([url.rlike(glob_regex(p)) for p in patterns])


def is_kept_response(url: Column, content_type: Column, patterns: Column | Sequence[str] = ()) -> Column:
    low = F.lower(F.coalesce(content_type, F.lit("")))
    return contains_any(low, R.DOCUMENT_MIME_TYPES) | matches_glob(url, patterns)


def source_domain(url: Column) -> Column:
    return F.lower(host_of(url))


def content_path(file_hash: Column, ext: Column) -> Column:
    """Content-addressed location ``ab/abcdef....pdf``."""
    return F.concat(F.substring(file_hash, 1, 2), F.lit("/"), file_hash, F.lit("."), ext)


def optional(col: Column) -> Column:
    return filled(col)
