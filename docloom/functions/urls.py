"""URL identity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of parameters that must not be kept, those that an inventory leaves out, and those that only track (fixed values).
SENSITIVE = "token|password|secret|authorization|api[-_]?key|session|signature|credential"
INVENTORY_SENSITIVE = "token|password|secret|session|auth|api.?key|signature"
TRACKING = "^(?:utm_|qhclickid|saasdianping|addrid)"
_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, i: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query, 5 fragment; empty where absent."""
    return F.regexp_extract(url, _URL, i)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(part(url, 2), r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)", 1))


def port(url: Column) -> Column:
    return F.regexp_extract(part(url, 2), r":(\d+)$", 1)


def userinfo(url: Column) -> Column:
    return F.regexp_extract(part(url, 2), r"^([^@]*)@", 1)


def _name(segment: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.substring_index(segment, "=", 1)), F.substring_index(segment, "=", 1))


def is_sensitive(url: Column) -> Column:
    """Some decoded parameter name is sensitive."""
    return F.exists(F.split(part(url, 4), "&"), lambda s: _name(s).rlike(f"(?i){SENSITIVE}"))


def is_web(url: Column) -> Column:
    return F.lower(part(url, 1)).isin("http", "https") & (host(url) != "")


def _netloc(url: Column) -> Column:
    scheme, p = F.lower(part(url, 1)), port(url)
    default = ((scheme == "http") & (p == "80")) | ((scheme == "https") & (p == "443")) | (p == "")
    return F.concat(host(url), F.when(default, "").otherwise(F.concat(F.lit(":"), p)))


def _build(scheme: Column, netloc: Column, path: Column, query: Column) -> Column:
    return F.concat(scheme, F.lit("://"), netloc, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def safe_url(url: Column) -> Column:
    """G1: the normal form with sensitive values redacted; null where the URL is none of the web."""
    query = F.array_join(F.transform(F.split(part(url, 4), "&"), lambda s: F.when(_name(s).rlike(f"(?i){SENSITIVE}"), F.concat(F.substring_index(s, "=", 1), F.lit("=REDACTED"))).otherwise(s)), "&")
    return F.when(is_web(url), _build(F.lower(part(url, 1)), _netloc(url), part(url, 3), query))


def url_error(url: Column) -> Column:
    """Why a URL is refused as a public one; null: it is not."""
    return F.when((userinfo(url) != "") | is_sensitive(url), "sensitive_url_rejected").when(~is_web(url), "invalid_url")


def public_url(url: Column) -> Column:
    return F.when(url_error(url).isNull(), safe_url(url))


def inventory_url(url: Column) -> Column:
    """Without session paths, sensitive and tracking parameters."""
    path = F.regexp_replace(part(url, 3), "(?i);jsessionid=[^/?;#]*", "")
    query = F.array_join(F.filter(F.split(part(url, 4), "&"), lambda s: ~_name(s).rlike(f"(?i){INVENTORY_SENSITIVE}") & ~_name(s).rlike(f"(?i){TRACKING}")), "&")
    net = F.concat(host(url), F.when(port(url) == "", "").otherwise(F.concat(F.lit(":"), port(url))))
    return F.when(is_web(url), _build(F.lower(part(url, 1)), net, path, query))


def normal_path(url: Column) -> Column:
    """The decoded path without empty, dot and dot-dot steps."""
    steps = F.filter(F.split(F.coalesce(F.try_url_decode(F.replace(part(url, 3), F.lit("+"), F.lit("%2B"))), part(url, 3)), "/"), lambda s: ~s.isin("", "."))
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def in_scope(url: Column, hosts: list[str], prefixes: list[str], by_host: dict[str, list[str]] | None = None) -> Column:
    """B2: the host is allowed and the normal path is, or is below, one of its prefixes."""

    def below(some: list[str]) -> Column:
        out = F.lit(False)
        for p in some:
            bare = p.rstrip("/")
            out = out | (normal_path(url) == bare) | F.startswith(normal_path(url), F.lit(bare + "/"))
        return out

    found = below(prefixes)
    if by_host:
        found = F.lit(False)
        for h, some in sorted(by_host.items()):
            found = F.when(host(url) == h, below(some)).otherwise(found)
    return host(url).isin(hosts) & found


def private_address(h: Column) -> Column:
    """Local names and non-global IPv4 or IPv6 literals."""
    bare = F.lower(F.rtrim(h, F.lit(".")))
    four = r"^(?:0|10|127)\.|^169\.254\.|^192\.168\.|^172\.(?:1[6-9]|2\d|3[01])\.|^100\.(?:6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.|^192\.0\.[02]\.|^198\.(?:1[89]|51\.100)\.|^203\.0\.113\.|^(?:22[4-9]|2[3-5]\d)\."
    is_four = bare.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$")
    six = r"^\[?(?:::1?|f[cd][0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*|ff[0-9a-f]{2}:.*)\]?$"
    return (bare == "localhost") | bare.rlike(r"\.(?:localhost|local|internal)$") | (is_four & bare.rlike(four)) | bare.rlike(six)


def document_id(url: Column) -> Column:
    """The docid parameter if it is all digits."""
    found = F.regexp_extract(part(url, 4), "(?:^|&)docid=([^&]*)", 1)
    return F.when(found.rlike("^[0-9]+$"), found)


def file_name(url: Column) -> Column:
    """The decoded last step of the path; ``file`` if there is none."""
    last = F.element_at(F.split(part(url, 3), "/"), -1)
    return F.coalesce(F.nullif(F.coalesce(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), last), F.lit("")), F.lit("file"))


def media_type(header: Column) -> Column:
    """The lower-case type of a Content-Type value."""
    return F.lower(F.trim(F.substring_index(header, ";", 1)))


def charset(header: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(header, "(?i)charset=[\"']?([^;\"'\\s]+)", 1)), F.lit(""))
