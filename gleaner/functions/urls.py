"""URL columns: validate, resolve, canonicalise. Bad input never raises; it gives null or false.

An address is taken apart once per row into a struct and the parts are used from there (:func:`gleaner.functions.text.let`), which keeps
the expression small however often a part is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import fixed_values as fv
from gleaner.functions import text as tx

_PORT = r"(?::(?:[0-5]?\d{1,4}|6[0-4]\d{3}|65[0-4]\d{2}|655[0-2]\d|6553[0-5])?)?"
_HOST = r"(?:\[[0-9A-Fa-f:.]+\]|[^\s<>\[\]^|%:@#?/\\]+)"
_EDGE = r"[\x00-\x20]*"
_HTTP = rf"(?i)^{_EDGE}https?:[/\\]*(?:[^/?#\\@]*@)?{_HOST}{_PORT}(?:[/?#\\]|{_EDGE}$)"
_ANY = rf"^{_EDGE}[A-Za-z][A-Za-z0-9+.\-]*:[/\\]{{2,}}(?:[^/?#\\@]*@)?{_HOST}{_PORT}(?:[/?#\\]|{_EDGE}$)"
# scheme, user, host, port, path, query
_PARTS = rf"^([A-Za-z][A-Za-z0-9+.\-]*):[/\\]*([^/?#\\@]*@)?({_HOST})?({_PORT})([^?#]*)(\?[^#]*)?"


def _trimmed(url: Column) -> Column:
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$|[\t\r\n]", "")


def is_http_url(url: Column) -> Column:
    """Parses, and the scheme is http or https. Never null."""
    return F.coalesce(url.rlike(_HTTP), F.lit(False))


def _parts(url: Column) -> Column:
    def split(t: Column) -> Column:
        scheme = F.lower(F.regexp_extract(t, _PARTS, 1))
        port = F.regexp_extract(t, _PARTS, 4)
        usual = ((scheme == "http") & (port == ":80")) | ((scheme == "https") & (port == ":443")) | (port == ":")
        return F.struct(
            scheme.alias("scheme"),
            F.regexp_extract(t, _PARTS, 2).alias("user"),
            F.lower(F.regexp_extract(t, _PARTS, 3)).alias("host"),
            F.when(usual, F.lit("")).otherwise(port).alias("port"),
            F.regexp_extract(t, _PARTS, 5).alias("path"),
            F.substring(F.regexp_extract(t, _PARTS, 6), 2, 1 << 30).alias("query"),
        )

    return tx.let(_trimmed(url), split)


def _origin(p: Column) -> Column:
    return F.concat(p["scheme"], F.lit("://"), p["host"], p["port"])


def origin(url: Column) -> Column:
    return tx.let(_parts(url), _origin)


def host(url: Column) -> Column:
    return _parts(url)["host"]


def _path(path: Column) -> Column:
    """Escaped path without ``.`` and ``..`` steps; empty becomes ``/``."""
    escaped = F.replace(path, F.lit("\\"), F.lit("/"))
    for char, code in [(" ", "%20"), ('"', "%22"), ("<", "%3C"), (">", "%3E"), ("`", "%60"), ("{", "%7B"), ("}", "%7D")]:
        escaped = F.replace(escaped, F.lit(char), F.lit(code))

    chars = F.transform(F.split(escaped, ""), lambda c: F.when(c.rlike(r"[^\x00-\x7F]"), F.url_encode(c)).otherwise(c))
    escaped = F.when(escaped.rlike(r"[^\x00-\x7F]"), F.array_join(chars, "")).otherwise(escaped)

    def undot(raw: Column) -> Column:
        kept = F.aggregate(
            F.split(raw, "/"),
            F.array().cast("array<string>"),
            lambda acc, s: F.when(s == ".", acc)
            .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
            .otherwise(F.array_append(acc, s)),
        )
        tail = F.when(raw.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
        return (
            F.when(raw == "", F.lit("/"))
            .when(raw.rlike(r"/\.{1,2}(/|$)"), F.concat(F.array_join(kept, "/"), tail))
            .otherwise(raw)
        )

    return tx.let(escaped, undot)


def _decode(part: Column) -> Column:
    return F.coalesce(F.try_url_decode(part), part)


def _clean_query(query: Column, dropped: Sequence[str], dropped_prefix: str | None) -> Column:
    """Drop tracking parameters, order the rest by name (equal names keep their order), re-encode."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p, i: F.struct(
            _decode(F.regexp_extract(p, "^([^=]*)", 1)).alias("name"),
            i.alias("pos"),
            _decode(F.regexp_extract(p, r"^[^=]*=([\s\S]*)$", 1)).alias("value"),
        ),
    )

    def keep(pair: Column) -> Column:
        name = F.lower(pair["name"])
        ok = ~name.isin(*dropped)
        return ok & ~name.startswith(dropped_prefix) if dropped_prefix else ok

    encoded = F.transform(
        F.sort_array(F.filter(pairs, keep)),
        lambda p: F.concat(F.url_encode(p["name"]), F.lit("="), F.url_encode(p["value"])),
    )
    return F.when(query == "", F.lit("")).otherwise(F.array_join(encoded, "&"))


def _joined(p: Column, path: Column, query: Column) -> Column:
    whole = F.concat(
        p["scheme"], F.lit("://"), p["user"], p["host"], p["port"], path,
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
    )
    return F.regexp_replace(whole, "/$", "")


def _canonical(url: Column, dropped: Sequence[str], dropped_prefix: str | None = None) -> Column:
    def build(p: Column) -> Column:
        path = F.regexp_replace(_path(p["path"]), "(?<=.)/$", "")
        return tx.let(_clean_query(p["query"], dropped, dropped_prefix), lambda q: _joined(p, path, q))

    return tx.let(_parts(url), build)


def collected_url(url: Column) -> Column:
    """Canonical form of an http(s) URL; null for anything else."""
    return F.when(is_http_url(url), _canonical(url, fv.TRACKING_PARAMS))


def canonical_url(url: Column) -> Column:
    """Deduplication key: canonical URL of any ``scheme://`` address, else the normalised text."""
    parses = is_http_url(url) | (~url.rlike(rf"(?i)^{_EDGE}https?:") & url.rlike(_ANY))
    return F.when(parses, _canonical(url, fv.TRACKING_PARAMS)).otherwise(tx.normalize_text(url))


def link_key(url: Column) -> Column:
    """Key for listing source links: every ``utm_*`` parameter is ignored."""
    return F.when(is_http_url(url), _canonical(url, fv.LINK_TRACKING_PARAMS, "utm_")).otherwise(F.lower(tx.strip(url)))


def package_link_key(url: Column) -> Column:
    """Key for package source links: fragment and host case only."""
    key = tx.let(_parts(url), lambda p: _joined(p, _path(p["path"]), p["query"]))
    return F.when(is_http_url(url), key).otherwise(F.lower(tx.strip(url)))


def resolve(href: Column, base: Column) -> Column:
    """Absolute form of ``href`` as seen from ``base`` (not yet canonical)."""

    def join(v: Column) -> Column:
        link, p = v["link"], v["base"]
        here = F.concat(_origin(p), p["path"])
        return (
            F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
            .when(link.rlike(r"^[/\\]{2}"), F.concat(p["scheme"], F.lit(":"), link))
            .when(link.rlike(r"^[/\\]"), F.concat(_origin(p), link))
            .when(link.rlike("^(#|$)"), F.concat(here, F.when(p["query"] == "", F.lit("")).otherwise(F.concat(F.lit("?"), p["query"]))))
            .when(link.startswith("?"), F.concat(here, link))
            .otherwise(F.concat(_origin(p), F.coalesce(tx.null_if_blank(F.regexp_replace(p["path"], "[^/]*$", "")), F.lit("/")), link))
        )

    return tx.let(F.struct(_trimmed(href).alias("link"), _parts(base).alias("base")), join)


def resolved_url(href: Column, base: Column) -> Column:
    """Canonical absolute URL of a link on a page; null when it is not http(s)."""
    return tx.let(resolve(href, base), collected_url)
