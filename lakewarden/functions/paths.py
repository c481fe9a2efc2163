"""Storage locations: traversal, containment and bucket checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewarden.fixed_values import RESTRICTED_PARTS, RESTRICTED_ROOTS

_SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*)://"
_DEFAULT_PORTS = {"http": "80", "https": "443"}


def contains_traversal(path: Column) -> Column:
    """True for NUL or for a `.`/`..` segment, also when percent-encoded."""
    # only what could hide a segment is decoded, so a bad escape elsewhere changes nothing
    decoded = path
    for code, sign in (("2e", "."), ("2f", "/"), ("5c", "\\\\"), ("00", "\0")):
        decoded = F.regexp_replace(decoded, f"(?i)%{code}", sign)
    dotted = F.exists(F.split(decoded, "[/\\\\]"), lambda s: s.isin(".", ".."))
    return F.coalesce(dotted | path.contains("\0") | decoded.contains("\0"), F.lit(False))


def unsafe_key(key: Column) -> Column:
    return F.coalesce(key.rlike("[?#%]") | contains_traversal(key), F.lit(False))


def table_root(path: Column) -> Column:
    """Table folder of a location: a trailing file name and a `metadata` folder are dropped."""
    trimmed = F.regexp_replace(path, "/+$", "")
    folder = F.regexp_replace(trimmed, "(^|/)[^/]*\\.[^/]*$", "")
    return F.regexp_replace(folder, "(?i)(^|/)metadata$", "")


def schemes_compatible(left: Column, right: Column) -> Column:
    a, b = F.lower(left), F.lower(right)
    return (a == b) | (a.isin("abfs", "abfss") & b.isin("abfs", "abfss"))


def restricted_local(path: Column) -> Column:
    normal = F.lower(F.replace(path, F.lit("\\"), F.lit("/")))
    hit = normal.contains("\0")
    for root in RESTRICTED_ROOTS:
        hit = hit | normal.startswith(root)
    for part in RESTRICTED_PARTS:
        hit = hit | normal.contains(part)
    return hit


def bucket_of(location: Column) -> Column:
    """Bucket of an object-store location, null for other schemes or an empty bucket."""
    bucket = F.regexp_extract(location, "^(?i:s3|minio)://([^/]*)", 1)
    return F.when(F.btrim(bucket) != "", bucket)


def _scheme(uri: Column) -> Column:
    return F.lower(F.regexp_extract(uri, _SCHEME, 1))


def _authority(uri: Column) -> Column:
    return F.regexp_extract(uri, _SCHEME + "([^/?#]*)", 2)


def _path(uri: Column) -> Column:
    return F.regexp_extract(uri, _SCHEME + "[^/?#]*([^?#]*)", 2)


def _host_key(uri: Column) -> Column:
    """Lower-case user, host and port, with the default port of the scheme filled in."""
    authority = F.lower(_authority(uri))
    port = F.regexp_extract(authority, ":([0-9]+)$", 1)
    default = F.lit("")
    for scheme, number in _DEFAULT_PORTS.items():
        default = F.when(_scheme(uri) == scheme, F.lit(number)).otherwise(default)
    bare = F.regexp_replace(authority, ":[0-9]+$", "")
    return F.concat_ws(":", bare, F.when(port != "", port).otherwise(default))


def _inside(path: Column, folder: Column) -> Column:
    return (path == folder) | path.startswith(F.concat(folder, F.lit("/")))


def location_violation(file_path: Column, table_location: Column) -> Column:
    """Why a file reference may not be read for a table; null when it is fine."""
    remote = F.instr(file_path, "://") > 0
    scheme = _scheme(file_path)
    no_table = F.coalesce(F.btrim(table_location), F.lit("")) == ""
    table_has_scheme = F.coalesce(F.instr(table_location, "://") > 0, F.lit(False))
    table_scheme = _scheme(table_location)
    table_is_local = ~table_has_scheme | (table_scheme == "file")
    local_root = F.lower(
        F.when(table_has_scheme, table_root(_path(table_location))).otherwise(
            table_root(table_location)
        )
    )
    local_path = F.lower(F.when(remote, _path(file_path)).otherwise(file_path))
    rooted = local_path.startswith("/")
    prefix = table_root(_path(table_location))
    is_file = scheme == "file"

    return (
        F.when(F.coalesce(F.btrim(file_path), F.lit("")) == "", F.lit(None).cast("string"))
        .when(file_path.contains("\0"), F.lit("RESTRICTED_PATH"))
        .when(contains_traversal(file_path), F.lit("PATH_TRAVERSAL"))
        .when(remote & (scheme == ""), F.lit("INVALID_URI"))
        .when(remote & is_file & restricted_local(_path(file_path)), F.lit("RESTRICTED_PATH"))
        .when(~remote & restricted_local(file_path), F.lit("RESTRICTED_PATH"))
        .when(
            no_table,
            F.when(remote & scheme.isin("http", "https"), F.lit("HTTP_REQUIRES_TABLE")),
        )
        .when(remote & is_file & ~table_is_local, F.lit("CROSS_SCHEME"))
        .when(~remote & ~table_is_local, F.lit("LOCAL_FOR_REMOTE"))
        .when(
            (is_file | ~remote) & rooted & ~_inside(local_path, local_root), F.lit("OUTSIDE_TABLE")
        )
        .when(is_file | ~remote, F.lit(None).cast("string"))
        .when(~table_has_scheme, F.lit("CROSS_SCHEME"))
        .when(~schemes_compatible(scheme, table_scheme), F.lit("SCHEME_MISMATCH"))
        .when(_host_key(file_path) != _host_key(table_location), F.lit("AUTHORITY_MISMATCH"))
        .when(prefix.isin("", "/"), F.lit("EMPTY_ROOT_PREFIX"))
        .when(~_inside(_path(file_path), prefix), F.lit("OUTSIDE_TABLE"))
    )
